"""Mail-archive and document-corpus analytics as Spark DataFrame jobs."""
