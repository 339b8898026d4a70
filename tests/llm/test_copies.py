"""Exact duplicates, SimHash components and repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from chronofold.llm import exact_dedup, graph, simhash, suffix
from tests.llm.conftest import EDGE, rows
from tests.oracle import connect, differences
import __spark_entry__ as contract


def order(value):
    return (value is None, value or 0)


# --- exact duplicates -----------------------------------------------------------------------------------------------


def test_trie_keeps_what_was_inserted():
    rng = random.Random(1)
    trie, seen = exact_dedup.PatriciaTrie(), {}
    for n in range(3000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12)))
        assert trie.at(key, lambda n=n: [n]) == [seen.setdefault(key, n)]
    assert {k: v[0] for k, v in trie.items()} == seen
    spilled = {}
    while trie.root.below:
        spilled |= {k: v[0] for k, v in trie.spill()}
    assert spilled | {k: v[0] for k, v in trie.items()} == seen and trie.bytes == 0


@pytest.mark.parametrize("trie_bytes", [1 << 25, 2000])
def test_exact_edge_cases(edge, trie_bytes):
    got = rows(exact_dedup.duplicate_owners(edge, trie_bytes=trie_bytes), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups = defaultdict(list)
    for doc_id, text, *_ in EDGE:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    expected = []
    for text, ids in groups.items():
        for n, doc_id in enumerate(sorted(ids, key=order)):
            expected.append((doc_id, min(ids, key=order), len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert exact_dedup.drop_duplicates(edge).count() == len(groups)
    assert exact_dedup.drop_duplicates(edge).columns == edge.columns


def test_exact_with_spills_equals_sql(spark, sf_dir, docs):
    sql = contract.oracle_sql()["op5_exact_dedup"]
    assert differences(contract.queries()["op5_exact_dedup"](spark, sf_dir), connect(sf_dir), sql) is None
    assert differences(exact_dedup.duplicate_owners(docs, trie_bytes=20_000), connect(sf_dir), sql) is None


# --- SimHash --------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, radius=4):
    fps = sorted({fp for _, fp in pairs})
    top = {fp: fp for fp in fps}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, a in enumerate(fps):
        for b in fps[k + 1 :]:
            if bin(a ^ b).count("1") <= radius:
                top[root(b)] = root(a)
    least = {}
    for doc_id, fp in pairs:
        if doc_id is not None:
            least[root(fp)] = min(doc_id, least.get(root(fp), doc_id))
    return [(doc_id, f"{fp:016x}", least.get(root(fp))) for doc_id, fp in pairs]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_simhash_equals_brute_force(docs, texts, bucket):
    got = rows(simhash.near_duplicates(docs, bucket=bucket), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute_components([(i, brute_fingerprint(t)) for i, t in texts.items()]))


def test_simhash_edge_cases(edge, empty):
    got = rows(simhash.near_duplicates(edge), "doc_id", "fingerprint", "component_id")
    expected = brute_components([(r[0], brute_fingerprint(r[1])) for r in EDGE])
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert simhash.drop_near(edge).count() == len({c for *_, c in expected})
    assert simhash.near_duplicates(empty).count() == 0


def test_index_finds_every_pair():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for c in centres]))
    index = simhash.GrayIndex(values)
    found = {(int(a), int(b)) for low, high in index.links(4, block=7) for a, b in zip(low, high)}
    v = index.values
    assert found == {(a, b) for a in range(len(v)) for b in range(a + 1, len(v)) if bin(int(v[a] ^ v[b])).count("1") <= 4}
    assert len(list(simhash.forest(values, 4))) == len(values) - 20


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(5, 5)]
    got = dict(rows(graph.components(spark.createDataFrame(links, "a long, b long")), "node", "label"))
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(51)}


# --- repeated byte strings --------------------------------------------------------------------------------------------


def brute_repeats(pairs, length=50):
    first = {}
    for doc_id, text in pairs:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            own = order(doc_id)
            first[data[p : p + length]] = min(own, first.get(data[p : p + length], own))
    out = []
    for doc_id, text in pairs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < order(doc_id):
                gone[p : p + length] = b"\1" * length
        rest = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    return out


REPEAT_COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("common", [suffix.COMMON, 3])
def test_repeats_equal_brute_force(docs, texts, common):
    got = rows(suffix.remove_repeats(docs, common=common), *REPEAT_COLUMNS)
    assert got == sorted(brute_repeats(list(texts.items())))


def test_repeats_edge_cases(edge, empty):
    small = [r[:2] for r in EDGE if r[0] not in (10, 11)]
    got = rows(suffix.remove_repeats(edge), *REPEAT_COLUMNS)
    assert sorted((g for g in got if g[0] not in (10, 11)), key=str) == sorted(brute_repeats(small), key=str)
    size = len(EDGE[-1][1].encode())
    assert [g[1:4] for g in got if g[0] in (10, 11)] == [(size, 0, 0), (size, size, 1)]
    assert suffix.remove_repeats(empty).count() == 0


def test_index_marks_equal_brute_force():
    rng = random.Random(3)
    for length in (6, 9):
        for _ in range(60):
            parts = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 2 * length))) for _ in range(rng.randint(1, 12))})
            owners = np.array([rng.randint(0, 5) for _ in parts])
            marks = suffix.smaller_owners(parts, owners, length)
            for i, part in enumerate(parts):
                for p in range(len(part) - length + 1):
                    found = any(part[p : p + length] in other and owners[k] < owners[i] for k, other in enumerate(parts))
                    assert bool(marks[i] >> p & 1) == found


def test_segments_of_long_texts_cover_all_windows(monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 64)
    text = bytes(random.Random(4).choices(b"abcd ", k=1000))
    windows = [first + k for _, begins, counts in suffix.segments(text) for first, n in zip(begins, counts) for k in range(n)]
    assert windows == list(range(len(text) - 49))
