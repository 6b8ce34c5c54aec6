"""Reading a sentencepiece BPE model file: its pieces, scores and kinds."""

from __future__ import annotations

from dataclasses import dataclass

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    unknown_surface: str


def read_vocabulary(model: bytes) -> Vocabulary:
    """Refuses models whose normalisation or merge rules the encoder does not implement."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    trainer, rules = proto.trainer_spec, proto.normalizer_spec
    supported = (
        trainer.model_type == 2
        and trainer.byte_fallback
        and not trainer.treat_whitespace_as_suffix
        and not rules.precompiled_charsmap
        and rules.add_dummy_prefix
        and not rules.remove_extra_whitespaces
        and rules.escape_whitespaces
        and not proto.denormalizer_spec.precompiled_charsmap
    )
    kinds = tuple(p.type for p in proto.pieces)
    if not supported or set(kinds) & {USER_DEFINED, UNUSED}:
        raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
    return Vocabulary(
        tuple(p.piece for p in proto.pieces),
        tuple(p.score for p in proto.pieces),
        kinds,
        trainer.unk_surface,
    )


def normal_pieces(model: bytes) -> list[str]:
    vocabulary = read_vocabulary(model)
    return [p for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True) if k == NORMAL]
