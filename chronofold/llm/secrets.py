"""Secret scans with multipart credential linking, in DataFrame functions only.

Three strong kinds are reported wherever they stand (`assign`, `access`, `hex`). Three weak kinds are candidates: a name given
as an identifier (`user`), a long token of mixed letters and digits (`blob`), and an address (`endpoint`). The parts of a
credential complement one another: an identifier and a secret, and an endpoint with both. A candidate is reported only
if its complements stand within its scope, the interval that reaches `scope` characters beyond it on both sides.

Matches become rows: a text split at a pattern gives the gaps, the pattern gives the matches, and a running sum of their
lengths gives positions. The interval join of candidates with complements is a running maximum of ends before and a
running minimum of starts behind, so a scope full of parts costs no pairs. All windows are within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import whole_text

SCOPE = 300

# Patterns of the strong kinds. Runs of the last two are maximal, so a minimum length in the pattern is the
# same as dropping short matches afterwards; for the first it is not.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}+"
# Patterns of the weak kinds.
USER = r"""(?i:user(?:name)?|login|client_?id|account(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}"""
BLOB = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}+={0,2}"
ENDPOINT = r"https?://[^\x20\x09-\x0D\"'<>]+"

STRONG = ("assign", "access", "hex")
KINDS = (*STRONG, "user", "blob", "endpoint")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, USER, BLOB, ENDPOINT)))
IDENTIFIER, SECRET, PLACE = ("access", "user"), ("assign", "hex", "blob"), ("endpoint",)


PART = "array<struct<kind:int,gap:int,length:int,kept:boolean>>"


def _matches(text: Column, kind: str) -> Column:
    """The matches of a kind in order, each with the length of the gap before it."""
    pattern = F.lit(PATTERNS[kind])
    least = (lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_LEAST) if kind == "assign" else lambda hit: F.lit(True)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.zip_with(
        F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(hits)),
        hits,
        lambda gap, hit: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.length(gap).alias("gap"), F.length(hit).alias("length"), least(hit).alias("kept")
        ),
    )
    return F.when(text.rlike(PATTERNS[kind]), pairs.cast(PART)).otherwise(F.array().cast(PART))


def _within(names: tuple[str, ...], scope: int) -> Column:
    """Whether a part of these kinds reaches into the scope of the row, from before or from behind."""
    own = F.col("kind").isin(*(KINDS.index(n) for n in names))
    document = Window.partitionBy("id", "hash")
    ahead = document.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = document.orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    last, following = F.max(F.when(own, F.col("end"))).over(ahead), F.min(F.when(own, F.col("start"))).over(behind)
    return F.coalesce(last >= F.col("start") - scope, F.lit(False)) | F.coalesce(following <= F.col("end") + scope, F.lit(False))


def scan_secrets(df: DataFrame, text: str = "text", id_col: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """One row per row of `df`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind, comma-joined; base_sha256 is of those
    of the strong kinds alone. A null text is empty; empty texts have no spans. Repeated rows are reported each. Ids may be
    null or repeated, other columns are not read. An empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    found = docs.select("id", F.sha2("text", 256).alias("hash"), F.concat(*(_matches(F.col("text"), k) for k in KINDS)).alias("parts"))
    # Rows that are repeated whole have the same parts: they are scanned as one from here on.
    once = found.groupBy("id", "hash").agg(F.first("parts").alias("parts"), F.count("*").alias("copies"))
    # A part of kind -1 stands for the document itself.
    document = F.expr(f"cast(array(named_struct('kind', -1, 'gap', 0, 'length', 0, 'kept', false)) as {PART})")
    rows = once.select("id", "hash", "copies", F.posexplode(F.concat(document, "parts")).alias("place", "part")).select("*", "part.*")
    end = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("id", "hash", "kind").orderBy("place"))
    parts = rows.withColumn("end", end).where("kept OR kind = -1").withColumn("start", F.col("end") - F.col("length"))
    linked = parts.select("*", _within(IDENTIFIER, scope).alias("by_identifier"), _within(SECRET, scope).alias("by_secret"))
    kind = {name: F.col("kind") == KINDS.index(name) for name in KINDS}
    weak = (kind["user"] & F.col("by_secret")) | (kind["blob"] & F.col("by_identifier"))
    weak = weak | (kind["endpoint"] & F.col("by_identifier") & F.col("by_secret"))
    strong = F.col("kind").between(0, len(STRONG) - 1)
    span = F.struct("start", "kind", "end")
    gathered = linked.groupBy("id", "hash").agg(
        F.first("copies").alias("copies"),
        *(F.count(F.when(kind[name], 1)).alias(f"n_{name}") for name in STRONG),
        F.count(F.when(weak, 1)).alias("n_linked"),
        F.sort_array(F.collect_list(F.when(strong, span))).alias("base"),
        F.sort_array(F.collect_list(F.when(strong | weak, span))).alias("all"),
    )
    names = F.array(*map(F.lit, KINDS))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    return gathered.select("*", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("id").alias("doc_id"), *(f"n_{n}" for n in STRONG), F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"), "n_linked"
    )
