"""Secret scans with corpus-wide ownership frequency.

Patterns find candidate secrets in the text. The hash of every candidate is then
counted over the whole corpus by distinct repositories and owners: what several
owners hold, each in repositories of their own, is a widely copied example; what one
owner holds, in however many repositories, and looks random is a live-looking
credential. Base kinds are always reported; kinds that would be noise by themselves
(long mixed strings, tokens of services, private keys) are reported as spans only
where ownership says they are live.

A secret is an example if at least ``EXAMPLE_OWNERS`` owners hold it, or
``COPIED_OWNERS`` in at least ``COPIED_REPOSITORIES`` repositories together; a
repository counts once for each owner that it is named with.

The scan writes one row per match, lengths and hashes, never a value, to a table that
counting and report both read. Places are running sums of the lengths of a text's
matches, so work grows with their number. Counting is two grouped aggregates (hash
and owner, then hash), combined before each shuffle, so an example in a third of all
documents costs a row a task; the counts come back to the matches by hash and one of
``SALTS`` numbers. What lies under a base span is told by the furthest end before it
and the next start behind it, in one ordered pass.

Only built-in functions, no Python. A null text counts as empty; a null owner counts
as one more owner of its own, as does an empty one; null ids stay null; repeated rows
are reported each; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipyard.llm.common import written


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the secret, the characters it must have,
    and whether it counts by itself (``base``)."""

    name: str
    pattern: str
    group: int
    least: int
    base: bool


#: A private key from header to END line; the group is its body, also as text of a
#: program (quotes, backslashes), without the header fields of encrypted keys.
PEM = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"(?:[\x20\r\n]{0,9}[A-Za-z-]{1,20}:\x20[^\r\n]{0,100}){0,5}"
    r"""([A-Za-z0-9+/=\\"',.\x20\t\r\n]+)-----END [A-Z ]{0,20}PRIVATE KEY-----"""
)

#: Order is the order of kinds at one place. Patterns with a minimum length find
#: the same as the open pattern with short matches dropped, as their runs are maximal.
KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Kind("service", r"(?:gh[pousr]_|sk-|xox[abprs]-)[A-Za-z0-9-]{20,}", 0, 20, False),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 30, False),
    Kind("pem", PEM, 1, 20, False),
    Kind("mixed", r"[A-Za-z0-9+/]{32,}", 0, 32, False),
)

#: Owners up to which a secret counts as somebody's own, and from which on as an example.
OWN_OWNERS = 1
EXAMPLE_OWNERS = 3
#: Fewer owners make an example if they hold it in so many repositories.
COPIED_OWNERS, COPIED_REPOSITORIES = 2, 4
#: Parts in which the matches of one hash meet its counts.
SALTS = 16

MATCH = "array<struct<k:int,rank:int,skipped:int,size:int,hash:string,random:boolean>>"


def _found(text: Column, rank: int, kind: Kind) -> Column:
    """All matches of a kind in order: array of (k, rank, characters since the match
    before, characters, hash and look of the value, both null for a short one)."""

    def matches(pieces: Column) -> Column:
        whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole
        zipped = F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("piece"), whole.alias("whole"), value.alias("value"))

        def one(x: Column, k: Column) -> Column:
            counts = F.length(x["value"]) >= kind.least
            return F.struct(
                k.cast("int").alias("k"),
                F.lit(rank).alias("rank"),
                F.length(x["piece"]).alias("skipped"),
                F.length(x["whole"]).alias("size"),
                F.when(counts, F.sha2(x["value"], 256)).alias("hash"),
                F.when(counts, _random_looking(x["value"])).alias("random"),
            )

        return F.transform(zipped, one).cast(MATCH)

    split = F.element_at(F.transform(F.array(F.split(text, kind.pattern, -1)), matches), 1)
    return F.when(text.rlike(kind.pattern), split).otherwise(F.array().cast(MATCH))


def _random_looking(value: Column) -> Column:
    """At least 8 different characters, a digit, and a letter."""
    return (F.size(F.array_distinct(F.split(value, ""))) >= 8) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def candidates(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match, and one without for a document that has none: ``row``, id,
    ``owner``, ``repository`` and the fields of ``_found``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.concat(*[_found(text, k, kind) for k, kind in enumerate(KINDS)])
    # A null owner differs from the empty one.
    named = F.coalesce(F.concat(F.lit("="), owner.cast("string")), F.lit(""))
    in_ = F.coalesce(F.concat(F.lit("="), repository.cast("string")), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), named.alias("owner"), in_.alias("repository"), every.alias("found"))
    return rows.select("row", "id", "owner", "repository", F.explode_outer("found").alias("x")).select("row", "id", "owner", "repository", "x.*")


def ownership(found: DataFrame) -> DataFrame:
    """Per hash the distinct owners and repositories that hold it, over the whole corpus."""
    each = found.where("hash IS NOT NULL").select("hash", "owner", "repository")
    by_owner = each.distinct().groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(
    docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text", own: int = OWN_OWNERS, example: int = EXAMPLE_OWNERS
) -> DataFrame:
    """One row per document: its id and ``spans``, an array by start and kind of
    (start, rank, end, kind, base, owners, repositories, verdict), ends exclusive, in
    code points. A verdict is ``live`` (at most ``own`` owners, random-looking),
    ``example`` (at least ``example`` owners, or fewer with many repositories) or
    ``unclear``; spans of kinds that are not base come only as ``live`` and outside of
    base spans."""
    found = written(candidates(docs, owner, repository, id_col, text_col), "secrets")
    names, bases = F.array(*[F.lit(k.name) for k in KINDS]), F.array(*[F.lit(k.base) for k in KINDS])
    upto = Window.partitionBy("row", "rank").orderBy("k")
    placed = found.withColumn("end", F.sum(F.col("skipped") + F.col("size")).over(upto).cast("int"))
    placed = placed.where("hash IS NOT NULL").select(
        "row", "rank", (F.col("end") - F.col("size")).alias("start"), "end", "hash", "random",
        F.get(names, F.col("rank")).alias("kind"), F.get(bases, F.col("rank")).alias("base"),
    )
    salted = ownership(found).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = placed.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["hash", "salt"])
    widely = (F.col("owners") >= example) | ((F.col("owners") >= COPIED_OWNERS) & (F.col("repositories") >= COPIED_REPOSITORIES))
    held = held.withColumn("verdict", F.when((F.col("owners") <= own) & F.col("random"), "live").when(widely, "example").otherwise("unclear"))

    by_start = Window.partitionBy("row").orderBy("start")
    before = by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    behind = by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    held = held.withColumns({"_end": F.max(F.when(F.col("base"), F.col("end"))).over(before), "_next": F.min(F.when(F.col("base"), F.col("start"))).over(behind)})
    covered = (F.coalesce("_end", F.lit(-1)) > F.col("start")) | (F.coalesce("_next", F.col("end")) < F.col("end"))
    shown = held.where(F.col("base") | ((F.col("verdict") == "live") & ~covered))
    span = F.struct("start", "rank", "end", "kind", "base", "owners", "repositories", "verdict")
    spans = shown.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    # Every document has a first row: a match of some kind, or none at all.
    rows = found.groupBy("row").agg(F.first("id").alias("id"))
    return rows.join(spans, "row", "left").select(F.col("id").alias(id_col), F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
