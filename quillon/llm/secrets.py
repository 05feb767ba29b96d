"""Operator 1: secret scan with multipart credential linking.

Strong patterns are reported wherever they stand.  Weak candidates (short or
loosely named secrets, account names, endpoints) are reported only where the
parts that complete a credential stand in the same scope: at most ``SCOPE`` code
points from the end of one to the start of the other, or overlapping.  A bare
string (hex or access) doesn't complete a candidate that it overlaps, as it is
the same piece of text.  Candidates become rows; one sweep over the positions of a
text keeps the farthest end and start of each part, so a text of many candidates
makes no pairs.  DataFrame and SQL functions only.

Cases: a null text is an empty one; positions are code points, ends exclusive;
matches of one kind don't overlap, kinds may; a weak candidate that overlaps a
strong span of the same part is dropped; rows that repeat a document get equal results; rows of a
null doc_id are scanned as well; a very long text is one row, whose matches are
summed up run by run; no result depends on ties; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusterio import checkpointed, read, small_side

SCOPE = 200
#: Fixed patterns of the base: name, pattern, group that is measured, least length.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # of AKIA[A-Z0-9]+ with 18 and [0-9a-f]+ with 16 characters: a run that is too short holds no long one
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
#: Weak candidates: name, pattern, measured group, least length.
WEAK = [
    ("weak_secret", r"""(?i:(password|passwd|pwd|passphrase|secret|token|api_?key|auth_?key|private_?key|credential))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("weak_id", r"""(?i:(username|user|login|account|client_?id|key_?id|access_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+_.-]+)""", 2, 3),
    ("endpoint", r"""(?i:(?:https?|ftp|sftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://)([^\x00-\x20"'<>]+)""", 1, 4),
]
KINDS = [k[0] for k in [*BASE, *WEAK]]
#: The part of a credential that each kind is, and the parts that complete it.
PART = {"assign": "secret", "hex": "secret", "access": "id", "weak_secret": "secret", "weak_id": "id", "endpoint": "endpoint"}
#: Kinds without a name or scheme beside them.
BARE = ("access", "hex")
NEEDS = {"weak_secret": ("id", "endpoint"), "weak_id": ("secret",), "endpoint": ("secret",)}
_SPAN = "struct<start:int,kind:int,end:int>"
#: A cheap test whether a kind can occur at all.
_HINT = {
    "assign": r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    "access": "AKIA",
    "hex": r"[0-9a-f]{16}",
    "weak_secret": r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
    "weak_id": r"""[:=]\x20*["']?[A-Za-z0-9@+_.-]{3}""",
    "endpoint": "://",
}
#: Matches that are summed up at once.
RUN = 64


def spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of all matches, left to right, whose measured group is long enough.

    The text between matches comes from split, the matches from extraction;
    their lengths add up to the positions.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole, lambda x: F.length(x))
    parts = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("b"), F.transform(whole, lambda x: F.length(x)).alias("m"), measured.alias("g"))
    number = KINDS.index(kind)

    def step(acc, x):
        start = acc["at"] + x["b"]
        end = start + x["m"]
        own = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["g"] >= least, F.concat(acc["found"], own)).otherwise(acc["found"]).alias("found"))

    def folded(parts):
        def run(acc, first):
            inner = F.aggregate(F.slice(parts, first, RUN), F.struct(acc["at"].alias("at"), empty.alias("found")), step)
            return F.struct(inner["at"].alias("at"), F.concat(acc["runs"], F.array(inner["found"])).alias("runs"))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), F.lit(RUN)), begin, run, lambda acc: F.flatten(acc["runs"]))

    # positions are running sums; run by run, so that a text of many matches copies no long array at each
    empty = F.array().cast(f"array<{_SPAN}>")
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("runs"))
    # an array of one, so that the matches are found once and not for every run
    found = F.element_at(F.transform(F.array(parts), folded), 1)
    hit = F.rlike(text, F.lit(_HINT[kind])) & F.rlike(text, F.lit(pattern))
    return F.when(hit, found).otherwise(empty)


def _part(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(PART[k]) for k in KINDS]), kind + 1)


def _listed(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(found), one), ",")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, r1 and r2 (which tell texts apart), base spans and all weak ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    base = F.concat(*[spans(F.col("text"), *k) for k in BASE])
    weak = F.concat(*[spans(F.col("text"), *k) for k in WEAK])
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("r1"), F.hash("text", "doc_id").alias("r2"), base.alias("base"), weak.alias("weak"))


def _alone(rows: DataFrame) -> DataFrame:
    """The spans without the weak ones that overlap a strong span of their part.

    One sweep: at a weak span's end, strong spans that began before it must not
    reach beyond its start.
    """
    start, end, weak = F.col("s.start"), F.col("s.end"), F.col("s.kind") >= len(BASE)
    so_far = Window.partitionBy("r1", "r2").orderBy(F.when(weak, end).otherwise(start), F.when(weak, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = {p: F.max(F.when(~weak & (_part(F.col("s.kind")) == p), end)).over(so_far) for p in sorted(set(PART.values()))}
    swept = rows.withColumns({f"strong_{p}": r for p, r in reach.items()})
    own = F.coalesce(*[F.when(_part(F.col("s.kind")) == p, F.col(f"strong_{p}")) for p in reach])
    return swept.filter(~weak | own.isNull() | (own <= start)).select("r1", "r2", "s")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(r1, r2, added): the weak spans that complementary parts support."""
    rows = found.filter(F.size("weak") > 0).select("r1", "r2", F.explode(F.concat("base", "weak")).alias("s")).distinct()
    rows = _alone(rows)
    bare = F.col("s.kind").isin([KINDS.index(k) for k in BARE])
    weak = F.col("s.kind") >= len(BASE)
    start, end, turn = F.col("s.start"), F.col("s.end"), F.col("e.turn")
    # a span opens (0), a bare one shuts (1), a candidate asks at the far end of its scope (2) and at its start (3)
    events = [(start, 0, F.lit(True)), (end, 1, bare), (end + scope, 2, weak), (start, 3, weak)]
    listed = F.array(*[F.when(when, F.struct(at.alias("at"), F.lit(n).alias("turn"))) for at, n, when in events])
    swept = rows.withColumn("e", F.explode(F.filter(listed, lambda e: e.isNotNull())))
    so_far = Window.partitionBy("r1", "r2").orderBy("e.at", "e.turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = {}
    for p in sorted(set(PART.values())):
        own = _part(F.col("s.kind")) == p
        swept = swept.withColumn(f"reach_{p}", F.max(F.when((turn == 0) & ~bare & own, end)).over(so_far))
        swept = swept.withColumn(f"open_{p}", F.max(F.when((turn == 0) & bare & own, start)).over(so_far))
        swept = swept.withColumn(f"shut_{p}", F.max(F.when((turn == 1) & own, end)).over(so_far))
        ahead = F.coalesce(F.col(f"reach_{p}") >= start - scope, F.lit(False)) | F.coalesce(F.col(f"open_{p}") >= end, F.lit(False))
        near[p] = F.when(turn == 2, ahead).otherwise(F.coalesce(F.col(f"shut_{p}") >= start - scope, F.lit(False)))
    met = F.lit(False)
    for k, parts in NEEDS.items():
        for p in parts:
            met = met | ((F.col("s.kind") == KINDS.index(k)) & near[p])
    good = swept.filter((turn >= 2) & met)
    return good.groupBy("r1", "r2").agg(F.collect_set("s").alias("added"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, base (strong spans), added (linked weak spans), as arrays."""
    found = checkpointed(candidates(docs))
    added = small_side(checkpointed(linked(found, scope)))
    joined = found.select("doc_id", "r1", "r2", "base").join(added, ["r1", "r2"], "left")
    return joined.select("doc_id", "base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")).alias("added"))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id",
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )
