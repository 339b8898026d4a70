"""Repair of conversations against brute force."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest
import xxhash

from chronofold.llm import conversations
from chronofold.llm.queries import ORACLE_SQL, op13_conversations
from tests.oracle import connect, differences

PATTERN = re.compile("(s?(ua)+)?")
BLANKS = " \t\n\x0b\f\r"


def least_audit(rows):
    """(cost, audit, lines) of the cheapest edits of (role, text, fault) rows, by trying every edit at every place."""
    behind = {"": {r: (0, "", []) for r in ("", "a")}}[""]  # what ends well: nothing written yet, or an assistant's turn last
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def closed(best):
        for _ in range(4):
            for last, after in follows.items():
                for new in after:
                    if new in "ua" and new in best:
                        cost, audit, lines = best[new]
                        name = {"u": "user", "a": "assistant"}[new]
                        option = (cost + 3, "I" + audit, [f"{name}:", *lines])
                        best[last] = min(best.get(last, option), option)
        return best

    best = closed(dict(behind))
    for role, text, fault in reversed(rows):
        ahead = {}
        more = 3 if fault == "truncated" else 0
        for last in follows:
            options = []
            if last in best:
                options.append((best[last][0] + 4, "D" + best[last][1], best[last][2]))
            if fault not in ("blank", "duplicate"):
                for new in follows[last]:
                    if new not in best:
                        continue
                    cost, audit, lines = best[new]
                    if role[:1] == new:
                        options.append((cost + more, "K" + audit, [f"{role}:{text}", *lines]))
                    if new != "s":
                        name = {"u": "user", "a": "assistant"}[new]
                        options.append((cost + 3 + more, "R" + audit, [f"{name}:{text}", *lines]))
            if options:
                ahead[last] = min(options)
        best = closed(ahead)
    return best[""]


def in_order(row):
    turn, role, text = row
    number = xxhash.xxh64_intdigest(text.encode(), 42)
    return turn is not None, turn or 0, role, number - (1 << 64) * (number >> 63)


def brute_report(rows):
    """The report of one conversation's (turn, role, text) rows."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=in_order)
    seen, judged = set(), []
    for _, role, text in rows:
        rest = text.strip(BLANKS)
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    cost, audit, lines = least_audit(judged)
    assert PATTERN.fullmatch("".join(line[0] for line in lines))
    counts = [sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, symbols string"


def reports(df):
    return {r["conv"]: tuple(r[n] for n in NAMES) for r in df.collect()}


def drawn(conversations_, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations_):
        for turn in range(rng.randrange(longest + 1)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice(["Yes.", "No", "  \n", "Why? ", None, f"Row {rng.randrange(4)}!", "é 😀.", "x" * 50])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3]), role, text, "clash"))
    return rows


def test_block_tables_give_the_least_of_the_cheapest_edits():
    rng = random.Random(3)
    for _ in range(400):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "t", rng.choice(["", "", "blank", "truncated"])) for _ in range(rng.randrange(14))]
        symbols = bytes(conversations.GO if f == "blank" else conversations.symbol(r, f == "truncated") for r, _, f in rows)
        cost, audit, lines = least_audit(rows)
        edits, state = conversations.trace(symbols, 0, 0, True)
        assert (edits, conversations.cost_of(edits, symbols)) == (audit, cost)
        roles, texts = conversations.apply_edits(edits, 0, [r for r, _, _ in rows], ["t"] * len(rows))
        assert [f"{r}:{t}" for r, t in zip(roles, texts)] == lines and conversations.END[state] == 0
        edges, growth = conversations.boundaries(symbols)
        assert conversations.vectors()[0][edges[0]][0] + growth == cost


@pytest.mark.parametrize("segment_rows", [1, 3, 4096])
def test_segments_chain_to_the_same_report(spark, segment_rows):
    """Conversations cut into many segments, over several partitions, equal those taken whole."""
    rows = drawn(40, 25, 5) + [(None, 1, "user", "Hi.", "c"), (None, 2, "assistant", "Yes.", "c")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = reports(conversations.report(conversations.repair(df, segment_rows=segment_rows)))
    by_conv = {c: [r[1:4] for r in g] for c, g in groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0])}
    assert found == {c: brute_report(g) for c, g in by_conv.items()}


def test_one_conversation_with_most_rows(spark):
    """A hot conversation with long runs of equal rows is dealt over partitions."""
    rng = random.Random(9)
    rows = [(1, rng.randrange(300) if rng.random() < 0.6 else 7, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"T {rng.randrange(500)}."]), "c") for _ in range(3000)]
    rows += [(1, 5, "user", "Same.", "c")] * 2000
    found = conversations.repair(spark.createDataFrame(rows, SCHEMA).repartition(4), segment_rows=200)
    assert found.count() > 10
    assert reports(conversations.report(found)) == {1: brute_report([r[1:4] for r in rows])}


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_conversations(spark, sf_dir).withColumnRenamed("conv_id", "conv")
    assert reports(got) == {conv: brute_report(kept) for conv, kept in brute_damage(rows).items()}


def test_query_equals_sql(spark, sf_dir):
    assert differences(op13_conversations(spark, sf_dir), connect(sf_dir), ORACLE_SQL["op13_conversations"]) is None


def test_damage_keeps_conversations_that_lose_all_rows(spark):
    rows = [(conv, turn, None, None, None) for conv in (None, *range(300)) for turn in (None, conv)]
    changed, dropped = conversations.damaged(spark.createDataFrame(rows, SCHEMA))
    found = reports(conversations.report(conversations.repair(changed, absent=dropped)))
    expected = {conv: brute_report(kept) for conv, kept in brute_damage([r[:4] for r in rows]).items()}
    assert found == expected and any(e[:-1] == (0, 0, 0, 0, 0, 0, "") for e in expected.values())


def test_repaired_rows_follow_the_pattern(spark):
    found = conversations.repair(spark.createDataFrame(drawn(20, 12, 8), SCHEMA))
    roles = {}
    for r in conversations.repaired_rows(found).orderBy("conv", "seg", "place").collect():
        roles[r["conv"]] = roles.get(r["conv"], "") + r["role"][0]
    assert roles and all(PATTERN.fullmatch(r) for r in roles.values())


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.report(conversations.repair(none)).count() == 0
