"""Filter audit, quality ledger and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mailloom.llm import conversation_repair as repair
from mailloom.llm import filter_audit, quality_ledger

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


# ---- filter audit -------------------------------------------------------------------------------


def spelled_steps(masks, filters):
    """Audit rows of {mask: (docs, good, toxic)} by counting every order on its own."""
    n = len(filters)
    rows, shapley = {}, Counter()
    for order in itertools.permutations(range(n)):
        for step, f in enumerate(order):
            gone = sum(1 << x for x in order[:step])
            here = [c for m, c in masks.items() if m >> f & 1 and not m & gone]
            removed = sum(c[0] for c in here)
            shapley[f] += removed
            rows["".join(filters[x] for x in order), step + 1] = (
                sum(c[0] for m, c in masks.items() if not m & (gone | 1 << f)),
                removed,
                sum(c[0] for m, c in masks.items() if m >> f & 1 and m & gone),
                sum(c[0] for m, c in masks.items() if m == 1 << f),
                sum(c[1] for c in here),
                sum(c[2] for c in here),
                f,
            )
    return {k: (*v[:-1], shapley[v[-1]]) for k, v in rows.items()}


@pytest.mark.parametrize("filters", ["A", "AB", "ABC", "ABCDE"])
def test_diagrams_give_every_order(filters):
    dice = random.Random(len(filters))
    for share in (0.1, 0.5, 1.0):
        masks = {m: (dice.randint(1, 3), dice.randint(0, 1), 0) for m in range(2 ** len(filters)) if dice.random() < share}
        found = filter_audit.part_steps(masks, filters)
        assert {(r[0], r[1]): r[2:] for r in found} == spelled_steps(masks, filters)


def test_swaps_share_nodes_and_come_back():
    diagram = filter_audit.Diagram(3, {0: (5, 0, 0), 1: (2, 0, 0), 3: (2, 0, 0), 6: (4, 1, 0)})
    before, weight = diagram.steps(), diagram.weights[diagram.root]
    for level in (0, 1, 0, 0, 1, 0):
        diagram.swap(level)
        assert diagram.weights[diagram.root] == weight == (13, 1, 0)
    assert diagram.order == [0, 1, 2] and diagram.steps() == before
    levels = list(filter_audit.neighbour_swaps(4))
    order, seen = list(range(4)), {(0, 1, 2, 3)}
    for level in levels:
        order[level : level + 2] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == 24 == len(levels) + 1


def test_audit_of_documents(spark):
    dice = random.Random(2)
    texts = ["", None, "one", "Some CAPITALS here", "a & b", "w " * 60, " ".join(f"w{i}" for i in range(60))]
    rows = [(i, dice.choice(texts), dice.choice(["x", "y", None, ""])) for i in range(60)]
    rows += [rows[3], rows[3], (None, "one", "x"), (None, None, None)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 50, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None)]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, toxic = Counter(), Counter()
    for i, q, x in labels:
        good[i] |= q == 1
        toxic[i] |= bool(x)
    masks = defaultdict(dict)
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and i > first[t],
        )
        mask = sum(1 << n for n, f in enumerate(fails) if f)
        had = masks[part or ""].get(mask, (0, 0, 0))
        known = i is not None
        masks[part or ""][mask] = (had[0] + 1, had[1] + (known and good[i]), had[2] + (known and toxic[i]))
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("own") for c in ("part", "mask", "n", "digest", "bits", "id", "good")})
    marks = spark.createDataFrame([(i, q, None if x is None else int(x)) for i, q, x in labels], LABELS).withColumn("text", F.lit(1))
    found = filter_audit.audit(filter_audit.document_masks(docs.repartition(7), marks)).collect()
    want = {(part, *k): v for part, m in masks.items() for k, v in spelled_steps(m, "ABCDE").items()}
    assert {tuple(r[:3]): tuple(r[3:]) for r in found} == want and len(found) == len(want)


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(filter_audit.document_masks(docs, labels)).count() == 0
    one = spark.createDataFrame([(1, None, None)], DOCS)
    found = filter_audit.audit(filter_audit.document_masks(one, labels))
    assert {(r.part, r.kept) for r in found.where("step = 5").collect()} == {("", 0)}
    with pytest.raises(ValueError):
        filter_audit.audit(one.selectExpr("'x' AS part", "0 AS mask", "1 AS docs", "0 AS good", "0 AS toxic"), "ABCDEFGH")


# ---- quality ledger -----------------------------------------------------------------------------


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(covered))


def ledger_texts():
    dice = random.Random(4)
    loop = " ".join(f"w{i % 9}" for i in range(40))
    texts = [None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 30, loop, "line\n" * 4 + "\n\nline \nother"]
    texts += [" ".join(dice.choice("abc") for _ in range(n)) for n in (7, 8, 9, 30, 200, 900)]
    texts += ["#$%& <b>" * 9, "é𝄞 漢字 x " * 25, "\x00 a\x0bb\x1c c", "long " * 20_000, "y" * 50_000]
    return texts


def test_ledger_measures(spark):
    texts = ledger_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("own") for c in ("h", "w", "n_words", "failures")})
    entered = quality_ledger.enter(docs.repartition(3))
    assert entered.columns == [*docs.columns, "ledger"]
    rows = {r.doc_id: r.ledger for r in entered.collect()}
    for i, text in enumerate(texts):
        assert tuple(rows[i][c] for c in quality_ledger.MEASURES) == measured(text), repr(text)[:60]
    assert "Exchange" not in quality_ledger.enter(docs)._jdf.queryExecution().executedPlan().toString().replace("RoundRobin", "")
    assert quality_ledger.enter(docs.limit(0)).count() == 0


def test_policies_and_ablations_read_the_bits_only(spark):
    dice = random.Random(8)
    rows = [(dice.choice(["a", "b", None]), dice.choice([*range(64), None])) for _ in range(400)]
    ledger = spark.createDataFrame(rows, "source string, bits long")
    names = [r.name for r in quality_ledger.RULES]
    found = quality_ledger.ablations(ledger, by=["source"], failures="bits").collect()
    want = {}
    for source in ("a", "b", None):
        bits = [b for s, b in rows if s == source]
        for version, policy in quality_ledger.POLICIES.items():
            mask = sum(1 << names.index(n) for n in policy)
            for n in policy:
                bit = 1 << names.index(n)
                known = [b for b in bits if b is not None]
                want[source, version, n] = (
                    len(bits), sum(bool(b & bit) for b in known), sum(b & mask == bit for b in known),
                    sum(not b & mask & ~bit for b in known),
                )
    assert {tuple(r[:3]): tuple(r[3:]) for r in found} == want
    kept = ledger.select("bits", quality_ledger.passes(F.col("bits"), quality_ledger.POLICIES["v2"]).alias("kept"))
    assert all(r.kept == (r.bits is not None and not r.bits & 15) for r in kept.collect())
    with pytest.raises(ValueError):
        quality_ledger.policy_mask(("no such rule",))


# ---- conversation repair ------------------------------------------------------------------------


def step(role, state):
    return repair.AFTER.get(role, {}).get(state)


def cheapest(symbols):
    """(cost, edits) by a plain walk over rows and states, strings compared as they are."""
    at = {repair.START: (0, "")}

    def insert(at):
        for _ in range(4):
            for state, (cost, edits) in list(at.items()):
                for role in "ua":
                    to = step(role, state)
                    if to is not None and (to not in at or (cost + 3, edits + "I") < at[to]):
                        at[to] = (cost + 3, edits + "I")
        return at

    for s in symbols:
        after = {}

        def offer(state, cost, edits):
            if state is not None and (state not in after or (cost, edits) < after[state]):
                after[state] = (cost, edits)

        for state, (cost, edits) in insert(at).items():
            offer(state, cost + 4, edits + "D")
            if s != "x":
                extra = 3 if s.isupper() else 0
                offer(step(s.lower(), state), cost + extra, edits + "K")
                for role in "ua":
                    offer(step(role, state), cost + extra + 3, edits + "R")
        at = after
    return min(at[s] for s in (repair.START, repair.ASSISTANT) if s in insert(at))


def every_repair(symbols, most=3):
    """All edit strings with few inserts, tried one by one."""
    best = None
    for n in range(len(symbols) + most + 1):
        for edits in itertools.product("DIKR", repeat=n):
            if sum(e != "I" for e in edits) != len(symbols):
                continue
            states, cost, row = {repair.START}, 0, iter(symbols)
            for e in edits:
                s = next(row) if e != "I" else None
                cost += {"D": 4, "I": 3, "K": 0, "R": 3}[e] + (3 if s and e != "D" and s.isupper() else 0)
                if e in "KR" and s == "x":
                    states = set()
                if e != "D":
                    roles = [s.lower()] if e == "K" else "ua"
                    states = {step(r, x) for r in roles for x in states} - {None}
            if states & {repair.START, repair.ASSISTANT} and (best is None or (cost, "".join(edits)) < best):
                best = (cost, "".join(edits))
    return best


def test_matrices_find_the_cheapest_edits():
    dice = random.Random(6)
    plain = repair.Grammar(())
    for n in (0, 1, 2, 3, 4):
        for _ in range(3 if n == 4 else 12):
            symbols = "".join(dice.choice(repair.SYMBOLS) for _ in range(n))
            found = plain.finish(plain.product(symbols, True))
            assert found == cheapest(symbols) == every_repair(symbols, 2 if n == 4 else 3), symbols
    for _ in range(300):
        symbols = "".join(dice.choice(repair.SYMBOLS) for _ in range(dice.randint(5, 60)))
        assert plain.finish(plain.product(symbols, True)) == cheapest(symbols), symbols


def test_rules_change_no_result(spark):
    dice = random.Random(7)
    sequences = ["".join(dice.choice("suaUAx") for _ in range(dice.randint(1, 12))) for _ in range(40)] * 3 + ["ua" * 500, "x" * 700, ""]
    rules = repair.learn_rules(spark.createDataFrame([(s,) for s in sequences], "symbols string"), most=30)
    assert 20 <= len(rules) <= 30
    grammar, plain = repair.Grammar(rules), repair.Grammar(())
    for s in set(sequences):
        assert grammar.finish(grammar.product(s, True)) == plain.finish(plain.product(s, True)) == cheapest(s)
        assert grammar.finish(grammar.product(s, False)) == cheapest(s)
    assert repair.learn_rules(spark.createDataFrame([], "symbols string")) == ()


def test_ropes_sort_as_strings():
    dice = random.Random(3)
    ropes = [repair.Rope(c) for c in ("", "K", "D", "KD")]
    for _ in range(200):
        ropes.append(dice.choice(ropes[-12:]) + dice.choice(ropes[-12:]))
        if ropes[-1].size > 400:
            ropes = ropes[:8]
    for _ in range(2000):
        a, b = dice.choice(ropes), dice.choice(ropes)
        assert repair.before(a, b) == (str(a) < str(b))


def mended(rows):
    """(counts and cost, audit, repaired lines) of one conversation, its rows as given."""
    rows = sorted(
        ((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()),
    )
    seen, symbols, faults = set(), "", Counter()
    for _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        tail = [c for c in text if not re.match(r"[\x20\x09-\x0D]", c)]
        if not tail:
            faults["blank"], symbol = faults["blank"] + 1, "x"
        elif (role, text) in seen:
            faults["duplicate"], symbol = faults["duplicate"] + 1, "x"
        elif tail[-1] not in ".!?":
            faults["truncated"], symbol = faults["truncated"] + 1, initial.upper()
        else:
            symbol = initial
        seen.add((role, text))
        symbols += symbol
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = cheapest(symbols)
    lines, state, left = [], repair.START, iter(rows)
    for e in audit:
        role, text = next(left)[1:] if e != "I" else (None, "")
        if e == "D":
            continue
        if e != "K":
            role = "assistant" if state == repair.USER else "user"
        state = step(role[:1], state)
        lines.append(f"{role}:{text}")
    counts = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost)
    return counts, audit, lines


def odd_conversations():
    dice = random.Random(12)
    roles = ["user", "assistant", "system", "tool", "", None, "ux", "User"]
    texts = ["Hello there.", "What?", "no end", "", " \n", None, "Fine! ", "tail.\t\x0b", "x. "]
    rows = []
    for conv in [*range(40), None]:
        for _ in range(dice.randint(1, 14)):
            weights = [6, 6, 2, 1, 1, 1, 1, 1]
            rows.append((conv, dice.choice([*range(12), None]), dice.choices(roles, weights)[0], dice.choice(texts)))
    rows += [(70, 1, "user", f"question {i}?") for i in range(30)] + [(71, None, "user", "Again.")] * 40
    rows += [(72, i, ("user", "assistant", "assistant")[i % 3], f"turn {i % 700}" + "." * (i % 5 > 0)) for i in range(4000)]
    rows += [(73, 0, "user", "word " * 60_000 + ".")]
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_repairs_of_odd_conversations(spark, coalesce):
    """Without coalescing the long conversation is several segments, whose matrices meet."""
    rows = odd_conversations()
    by_conv = defaultdict(list)
    for conv, *row in rows:
        by_conv[conv].append(row)
    want = {conv: mended(r) for conv, r in by_conv.items()}
    given = spark.createDataFrame(rows, CONVERSATIONS).withColumns({c: F.lit("own") for c in ("conv", "part", "audit", "digest", "blank", "edge")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        segments = repair.segments(repair.named(given, "conv_id", "turn", "role", "text")).where("conv = 72").count()
        assert segments > 1 or coalesce == "true"
        found = repair.find_repairs(given.repartition(5))
        assert {r.conv_id: (tuple(r[1:7]), r.audit) for r in found.collect()} == {c: w[:2] for c, w in want.items()}
        digests = {r.conv_id: r.repaired_sha256 for r in repair.repaired_digests(given, found).collect()}
        spelled = defaultdict(list)
        for r in sorted(repair.repaired_rows(given, found).collect(), key=lambda r: r.place):
            spelled[r.conv_id].append(f"{r.role}:{r.text}")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert digests == {c: hashlib.sha256("\n".join(w[2]).encode()).hexdigest() for c, w in want.items()}
    assert {c: spelled.get(c, []) for c in want} == {c: w[2] for c, w in want.items()}


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(30), None) for t in (*range(6), None) for r, x in (("assistant", "One. Two! x"), (None, None))]
    want = Counter()
    for c, t, r, x in rows:
        r, x = r if r is not None else " ", x if x is not None else " "
        key = ":".join(" " if v is None else str(v) for v in (c, t))
        kind = zlib.crc32(key.encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want[c, t, "user" if kind == 4 else r, x] += (kind != 0) + (kind == 3)
    found = repair.damage(spark.createDataFrame(rows, CONVERSATIONS))
    assert Counter(map(tuple, found.collect())) == +want


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert repair.find_repairs(repair.damage(empty)).count() == 0
