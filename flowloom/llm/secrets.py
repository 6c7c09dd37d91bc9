"""Secret scans with corpus-wide ownership frequency.

Base patterns find assignments, access keys and hexadecimal strings.  Further candidates are long
mixed tokens.  The hash of each candidate's value is counted by distinct owners and repositories over
the whole corpus: a value seen at many owners, or in many repositories for its owners, is a copied example,
one that belongs to few looks live.
Live mixed tokens are reported beside the base spans, which all stay.  DataFrame functions only; texts
are read once, later steps use positions and hashes.

Defined cases: null texts are empty; a null owner is an owner of its own; rows that repeat are each
reported and count as one repository; spans of different kinds may overlap, mixed tokens that touch a
base span are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.sized import keep

#: Patterns of the base kinds, in the order that ties between kinds follow.  Fixed values.
KEY_WORDS = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""(?i:({KEY_WORDS}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
MIXED = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
BLOCK = 256


def running_ends(lengths: Column) -> Column:
    """Inclusive running sums of an array, in blocks so that long arrays are not copied per element."""
    empty = F.array().cast("array<long>")

    def inside(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"] + x).alias("out")))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: inside(F.slice(lengths, b * BLOCK + 1, BLOCK))
    )
    joined = F.aggregate(
        blocks,
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
        lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.transform(b["out"], lambda v: v + acc["at"])).alias("out")),
    )
    return joined["out"]


def _pieces(name: str, pattern: str, likely: Column, group: int = 0) -> list[Column]:
    """Matches, values and lengths of the text between matches; null where the text has none."""
    text, found = F.col("_text"), F.lit(pattern)
    lengths = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    out = [F.when(likely, F.regexp_extract_all(text, found, F.lit(0))).alias(f"{name}_all"), F.when(likely, lengths).alias(f"{name}_gap")]
    return out + ([F.when(likely, F.regexp_extract_all(text, found, F.lit(group))).alias(f"{name}_val")] if group else [])


def _spans(name: str, kind: int, min_value: int, value: str) -> Column:
    """Array of (start, kind, end, hash of the value) from the pieces of one kind."""
    whole, gap, val = F.col(f"{name}_all"), F.col(f"{name}_gap"), F.col(f"{name}_{value}")
    ends = running_ends(F.zip_with(F.slice(gap, F.lit(1), F.size(whole)), whole, lambda g, m: g + F.length(m)))
    rows = F.zip_with(ends, F.arrays_zip(whole.alias("m"), val.alias("v")), lambda e, z: F.struct((e - F.length(z["m"])).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), z["v"].alias("value")))
    kept = F.filter(rows, lambda s: F.length(s["value"]) >= min_value)
    empty = F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")
    return F.when(F.size(whole) > 0, kept).otherwise(empty)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def scan(documents: DataFrame, owner: str, repository: str) -> DataFrame:
    """One row per document: its id, owner, repository and the candidate spans with value hashes."""
    rows = documents.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"), F.coalesce("text", F.lit("")).alias("_text"),
    )
    text = F.col("_text")
    found = rows.select(
        "doc_id", "owner", "repository",
        *_pieces("assign", ASSIGN, text.rlike(f"(?i){KEY_WORDS}"), 2),
        *_pieces("access", ACCESS, F.contains(text, F.lit("AKIA"))),
        *_pieces("hex", HEX, text.rlike(HEX)),
        *_pieces("mixed", MIXED, text.rlike(MIXED)),
    )
    arrays = found.select(
        "doc_id", "owner", "repository", _spans("assign", 1, 12, "val").alias("assign"), _spans("access", 2, 18, "all").alias("access"),
        _spans("hex", 3, 16, "all").alias("hex"), _spans("mixed", 4, 20, "all").alias("mixed"),
    )
    base = arrays.withColumn("base", F.concat("assign", "access", "hex")).drop("assign", "access", "hex")
    mixed = F.filter("mixed", lambda m: m["value"].rlike("[0-9].*[0-9].*[0-9].*[0-9]") & m["value"].rlike("[A-Za-z].*[A-Za-z].*[A-Za-z].*[A-Za-z]") & ~F.exists("base", lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"])))
    both = base.select("doc_id", "owner", "repository", F.when(F.size("mixed") > 0, F.concat("base", mixed)).otherwise(F.col("base")).alias("spans"))
    hashed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")))
    return both.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", hashed.alias("spans"))


def ownership(candidates: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """Per value hash: distinct owners and their distinct repositories, and whether it looks live.

    Live are values of at most ``max_owners`` owners in at most ``max_repositories`` repositories per owner on average.
    """
    per_owner = candidates.groupBy("hash", "owner").agg(F.count_distinct("repository").alias("n"))
    per_hash = per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories * F.col("n_owners"))
    return per_hash.withColumn("live", few)


def find_secrets(documents: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = 2, max_repositories: int = 16) -> DataFrame:
    """One row per document: base spans, all spans, and how many candidates look live or copied.

    Columns ``doc_id``, ``base`` (array of start, kind, end, hash), ``spans`` (the same with the n_owners and
    n_repositories of the value), ``n_live, n_copied``.
    """
    rows = keep(scan(documents, owner, repository))
    each = rows.select("row", "owner", "repository", F.explode("spans").alias("s")).select("row", "owner", "repository", "s.*")
    owned = keep(ownership(each, max_owners, max_repositories))
    judged = each.select("row", "start", "kind", "end", "hash").join(owned, "hash")
    span = F.struct("start", "kind", "end", "hash", "n_owners", "n_repositories")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("kind") < 4) | F.col("live"), span)).alias("reported"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"),
    )
    empty = F.array().cast("array<struct<start:long,kind:int,end:long,hash:string,n_owners:long,n_repositories:long>>")
    out = rows.join(per_row, "row", "left")
    return out.select(
        "doc_id", F.array_sort(F.filter("spans", lambda s: s["kind"] < 4)).alias("base"), F.array_sort(F.coalesce("reported", empty)).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
    )


def report(documents: DataFrame, **options) -> DataFrame:
    """Counts per kind, digest of the base spans and all spans as text, per document."""
    found = find_secrets(documents, **options)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:3], 1)]
    return found.select("doc_id", *counts, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"), "n_live", "n_copied")
