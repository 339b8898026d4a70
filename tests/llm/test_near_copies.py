"""The near stage of the pipeline against brute force over all pairs of five-word shingle sets."""

import random
import re

import pytest

import corpus_pipeline
from chronofold.llm import near_copies
from chronofold.llm.common import Scratch
from tests.llm.conftest import EDGE


def brute_sets(texts):
    out = {}
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return out


def similar(texts):
    sets = brute_sets(texts)
    ids = sorted(sets)
    pairs = ((a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])) for k, a in enumerate(ids) for b in ids[k + 1 :])
    return {(a, b): (n / u if u else 1.0) for a, b, n, u in pairs if n * 5 >= u * 4}


def smallest(texts, pairs):
    top = {i: i for i in texts}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    return sorted({root(i) for i in texts})


def test_near_stage_equals_brute_force_jaccard(spark, sf_dir, docs, texts):
    pairs = similar(texts)
    got = sorted(r["doc_id"] for r in corpus_pipeline.near(spark, docs, sf_dir).select("doc_id").collect())
    assert got == smallest(texts, pairs)


def families(sizes, seed, longest=400, edits=40):
    """Texts of edited copies of a base, the base among them; and one family of each size."""
    rng = random.Random(seed)
    texts = {}
    for size in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, longest))]
        for k in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // edits)) if k else 0):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(copy)
    return texts


def linked(spark, texts, **options):
    """{doc_id: name of its component}, by the links alone."""
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    scratch = Scratch(spark, "test-near")
    made = scratch.table(near_copies.sketches(df, "text", "doc_id"), "sketches")
    found = near_copies.near_copy_links(made, lambda keys: near_copies.sets_of(df, "text", "doc_id", keys), scratch, **options)
    label = {r["node"]: r["label"] for r in found.collect()}
    return {r["doc_id"]: label.get(r["node"], r["node"]) for r in made.select("doc_id", "node").collect()}


def assert_components(texts, component, pairs):
    """Every pair of every band of similarity is linked, and components are those of brute force."""
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 0.95), (0.95, 1.01)):
        some = [p for p, j in pairs.items() if low <= j < high]
        found = sum(component[a] == component[b] for a, b in some)
        print(f"{low}: {found} of {len(some)} pairs linked")
        assert found == len(some)
    assert len(set(component.values())) == len(smallest(texts, pairs))


def test_recall_by_similarity(spark):
    texts = families([4] * 120, 7)
    assert_components(texts, linked(spark, texts), similar(texts))


def test_recall_in_large_groups(spark):
    """Groups of 60 and 200, in which most copies are similar enough to the base alone."""
    texts = families([60, 60, 200], 11, 300, 50)
    rng = random.Random(12)
    for family in range(2):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        for k in range(150):
            copy = list(base)
            for at in rng.sample(range(300), 5 if k else 0):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(copy)
    pairs = similar(texts)
    assert_components(texts, linked(spark, texts), pairs)


def test_texts_of_a_bucket_that_stay_apart(spark):
    """Copies of a base that is missing: similar to each other by about 0.7, so all have to be compared, none is linked."""
    rng = random.Random(13)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = {}
    for k in range(60):
        copy = list(base)
        for at in rng.sample(range(300), 6):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(copy)
    pairs = similar(texts)
    assert_components(texts, linked(spark, texts, nearest=2), pairs)


def test_large_buckets_are_dealt_out_again(spark):
    texts = families([4] * 30 + [80, 80], 17, 200)
    assert_components(texts, linked(spark, texts, bucket=20), similar(texts))


def test_near_stage_edge_cases(edge, empty):
    kept = near_copies.drop_near_copies(edge)
    assert kept.columns == edge.columns and kept.count() == len({frozenset(s) for s in brute_sets({k: r[1] for k, r in enumerate(EDGE)}).values()})
    assert near_copies.drop_near_copies(empty).count() == 0


def test_unlike_texts_of_a_bucket_are_not_paired(spark):
    """Copies of a base that is missing, similar by 0.6 to 0.75: buckets give next to no pairs, however many texts they hold."""
    rng = random.Random(19)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = {}
    for k in range(120):
        copy = list(base)
        for at in rng.sample(range(300), 8):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(copy)
    assert not similar(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    scratch = Scratch(spark, "test-near")
    nodes = scratch.table(near_copies.sketches(df, "text", "doc_id"), "nodes")
    members = scratch.table(near_copies.buckets_of(nodes, scratch, near_copies.BUCKET).selectExpr("bucket", "node", "node AS component"), "members")
    assert members.count() > len(texts)
    for nearest in (None, 1 << 20):
        assert near_copies.close_pairs(members, nodes, nearest).count() <= len(texts) // 10


def copies_of_a_missing_base(seed, words, edits, count):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    texts = {}
    for k in range(count):
        copy = list(base)
        for at in rng.sample(range(words), edits):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(copy)
    return texts


def members_of(spark, texts, bucket):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    scratch = Scratch(spark, "test-near")
    nodes = scratch.table(near_copies.sketches(df, "text", "doc_id"), "nodes")
    return nodes, scratch.table(near_copies.buckets_of(nodes, scratch, bucket).selectExpr("bucket", "node", "node AS component"), "members")


@pytest.mark.parametrize("bucket", [near_copies.BUCKET, 40, 20])
def test_a_pair_is_made_in_one_of_the_buckets_that_have_it(spark, monkeypatch, bucket):
    """Also where large buckets are dealt out again; no pair that some bucket has is left out."""
    texts = copies_of_a_missing_base(23, 300, 3, 60)
    nodes, members = members_of(spark, texts, bucket)
    node = {r["doc_id"]: (r["node"], r["fp"]) for r in nodes.collect()}
    held = {}
    for r in members.collect():
        held.setdefault(r["node"], set()).add(r["bucket"])
    near = [(node[a], node[b]) for a, b in similar(texts)]
    close = {(min(a, b), max(a, b)) for (a, x), (b, y) in near if held.get(a, set()) & held.get(b, set()) and ((x ^ y) & (2**64 - 1)).bit_count() <= near_copies.RADIUS}
    assert len(close) > 300
    monkeypatch.setattr(type(nodes), "distinct", lambda self: self)
    made = [(r["a"], r["b"]) for r in near_copies.close_pairs(members, nodes, 1 << 20).collect()]
    assert close <= set(made) and len(made) == len(set(made))


def test_unlike_long_texts_of_a_bucket_are_not_paired(spark):
    """Copies of a missing base that are similar by 0.7 or so, of more shingles than 512."""
    texts = copies_of_a_missing_base(29, 1500, 25, 60)
    assert not similar(texts)
    nodes, members = members_of(spark, texts, near_copies.BUCKET)
    assert near_copies.close_pairs(members, nodes, 1 << 20).count() <= len(texts) // 10


def test_no_round_follows_one_that_made_all_pairs(spark, monkeypatch):
    texts = copies_of_a_missing_base(31, 300, 4, 60)
    asked, made = [], near_copies.close_pairs
    monkeypatch.setattr(near_copies, "close_pairs", lambda members, nodes, nearest: asked.append(nearest) or made(members, nodes, nearest))
    assert_components(texts, linked(spark, texts, nearest=1 << 20), similar(texts))
    assert asked == [None, 1 << 20]
