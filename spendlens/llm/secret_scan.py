"""Secret scan with corpus-wide ownership frequency, in DataFrame operations alone.

Candidates are assignments of a password-like name, cloud access keys, long hexadecimal
runs, and opaque tokens (long runs of letters and digits with several of each). For every
candidate value the corpus is asked how many owners and repositories hold it: a value that
many owners have, or many repositories of fewer owners, is a widely copied example; one that stays
with few and looks random is live. Values travel as digests, aggregated with partial counts.

The three base kinds are always reported. The method adds a ``live`` span at the value of
each live-looking candidate that is held by fewer than ``copied_owners`` owners and fewer than
``copied_repos`` repositories.

Places: a text is split at the matches, so a match starts after all gaps and matches
before it; a window sums their lengths, which stays linear in very long texts.

Defined cases: null text is empty; no candidates give empty lists; a null owner or
repository counts as one of its own; repeated rows are each reported and count once for
their owner; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import stored

#: Owners, or repositories, from which on a value is a widely copied example.
COPIED_OWNERS, COPIED_REPOS = 3, 6

# fixed values: the base patterns; a minimum length inside a pattern of one maximal run drops
# the same matches as a test afterwards
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1)
ACCESS = (r"AKIA[A-Z0-9]{16,}", 0)
HEX = (r"(?<![0-9a-f])[0-9a-f]{24,}", 0)
#: Runs of 16 letters and digits or more that have a digit.
OPAQUE = (r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{16,}", 0)
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "opaque": OPAQUE}
LEAST_ASSIGNED = 6
#: A live-looking value has so many letters and so many digits.
LIVE_LETTERS = LIVE_DIGITS = 4


def _found(text, kind: str, pattern: str, group: int):
    """Matches of a kind in order: the gap before each, its length, its value and the value's place in it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"), matches.alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    rows = F.transform(
        F.filter(rows, lambda r: r["match"].isNotNull()),
        lambda r, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), r["gap"].alias("gap"),
                              F.length(r["match"]).alias("size"), r["value"].alias("value")))
    none = F.array().cast("array<struct<kind:string,at:int,gap:int,size:int,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_cols: tuple[str, ...] = ("source", "lang"), copied_owners: int = COPIED_OWNERS,
                copied_repos: int = COPIED_REPOS) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (base and added),
    n_live (added spans), n_copied (base spans whose value is widely copied), most_owners and most_repos (of
    those that hold one of the row's candidate values)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    scan = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.to_json(F.struct(F.col(owner_col).cast("string").alias("r0"))).alias("owner"),
        F.to_json(F.struct(*[F.col(c).cast("string").alias(f"r{i}") for i, c in enumerate(repo_cols)])).alias("repo"))
    scan = stored(scan.select(
        F.monotonically_increasing_id().alias("row_key"), "doc_id", "owner", "repo",
        F.concat(*[_found(text, kind, *p) for kind, p in KINDS.items()]).alias("found")), "secret-scan")

    order = Window.partitionBy("row_key", "kind").orderBy("at")
    value = F.col("value")
    placed = (scan.select("row_key", "owner", "repo", F.explode("found").alias("f"))
              .select("row_key", "owner", "repo", "f.*")
              .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order))
              .withColumn("start", F.col("end") - F.col("size"))
              .where((F.col("kind") != "assign") | (F.length(value) >= LEAST_ASSIGNED))
              .withColumn("looks", (F.length(F.regexp_replace(value, "[^0-9]", "")) >= LIVE_DIGITS)
                          & (F.length(F.regexp_replace(value, "[^A-Za-z]", "")) >= LIVE_LETTERS))
              .where((F.col("kind") != "opaque") | F.col("looks"))
              .select("row_key", "owner", "repo", "kind", "start", "end", "looks", F.length(value).alias("size"),
                      F.sha2(value.cast("binary"), 256).alias("digest")))
    placed = stored(placed, "secret-candidates")
    held = (placed.select("digest", "owner", "repo").groupBy("digest", "owner", "repo").agg(F.count("*").alias("n"))
            .groupBy("digest").agg(F.count_distinct("owner").alias("owners"), F.count("*").alias("repos")))
    judged = placed.join(held, "digest").withColumn(
        "copied", (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos))

    def span(kind, rank, start):
        return F.struct(start.alias("start"), rank.alias("rank"), kind.alias("kind"), F.col("end").alias("end"))

    # a value ends where its match ends, in all kinds
    rank = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).otherwise(2)
    own = F.when(F.col("kind") != "opaque", span(F.col("kind"), rank, F.col("start")))
    live = F.when(F.col("looks") & ~F.col("copied"), span(F.lit("live"), F.lit(3), F.col("end") - F.col("size")))
    rows = judged.groupBy("row_key").agg(
        F.sort_array(F.collect_list(own)).alias("base"), F.sort_array(F.collect_set(live)).alias("live"),
        F.count_if((F.col("kind") != "opaque") & F.col("copied")).alias("n_copied"),
        F.max("owners").alias("most_owners"), F.max("repos").alias("most_repos"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("assign", "access", "hex")])

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def number(column):
        return F.coalesce(column, F.lit(0)).cast("long")

    return scan.select("row_key", "doc_id").join(rows, "row_key", "left").select(
        "doc_id", *[number(F.col(f"n_{k}")).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.coalesce(joined(F.col("base")), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(joined(F.sort_array(F.concat("base", "live"))), F.lit("")).alias("spans"),
        number(F.when(F.col("live").isNotNull(), F.size("live"))).alias("n_live"),
        *[number(F.col(c)).alias(c) for c in ("n_copied", "most_owners", "most_repos")])
