"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations alone.

A line's tokens are its shingles of five words (a line of fewer words is one token), as a
set of hashes. A line is removed if an earlier line, by (document, line number), has a
Jaccard similarity of at least 0.8 with it; lines are judged on the input.

* Order. Tokens are ordered by rarity, then by hash. A word is common if its hash bucket holds
  more than a fixed share of all words (so there are at most 1 / share common buckets); a token
  is the rarer the fewer common words it has. Every word is counted; the counts are combined
  before they are shuffled.
* Copies. A line with the words of an earlier line (by a hash) is removed unverified, and no line
  is held against it: that earlier line stands for it.
* Grams. A first prefix filter orders tokens by their rarest word, so that the prefix is the tokens
  of a few words, and all tokens of a word hold one of two grams of three words. Lines that similar
  share two grams; those that share fewer with lines of other words are left. Only grams and the
  lines' hashes are shuffled, once.
* Prefix filter, on the others, with their whole lines. Lines that similar share a token among each
  other's first n - ceil(0.8 n) + 1; only tokens that two lines hold are followed.
* Bitmap filter. A pair is made only if the lengths, the places of the token and the sets' bitmaps allow
  the similarity: the versions of one line, of which few are similar, are told apart where they meet.
* First round. Each line is verified against the earliest line of each of its prefix tokens.
  That settles dense groups with as many pairs as postings.
* Second round. Lines not settled are joined with all earlier lines of their tokens, under
  the same filters, and verified. Nothing is capped.
* Sieve. Texts and sets are fetched by key. A bitmap of the wanted keys, of bounded size, keeps most other
  rows out of the shuffle; the join decides.

Defined cases: a null or empty text has one empty line; lines without words stay; a line
is not held against itself, so rows that repeat an id get the same result (line n goes in each
if it goes in any); rows without an id are the last document; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Words are counted in so many buckets, and are common from this share of all words on.
WORD_BUCKETS = 1 << 14
COMMON_SHARE = 1 / (1 << 11)
#: So many grams of a line must be in lines of other words.
SHARED_GRAMS = 2
_LAST = (1 << 63) - 1
#: A word's place in its line, in the low bits.
_PLACE_BITS = 24
_PLACES = (1 << _PLACE_BITS) - 1
_LINE = ["doc_id", "line", "whole"]
#: A set's bitmap: bits in longs.
BITMAP_LONGS = 4
_BITS = [f"bits{k}" for k in range(BITMAP_LONGS)]
#: So many longs, at most, are broadcast to keep rows from a shuffle that no wanted key is like.
SIEVE_LONGS = 1 << 18


def _plain(text: Column) -> Column:
    """Null as empty, and each white space but the end of a line as a space."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    spaced = text
    for space in "\t\r\x0b\x0c":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    found = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c"))
    return F.when(found, spaced).otherwise(text)


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(WORD_BUCKETS - 1).cast("int")


def _hashed(lines: DataFrame) -> DataFrame:
    """Words as hashes, and ``whole``, a hash of the line's words in order: rows that repeat an id have other lines under one number."""
    return lines.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words").withColumn("whole", F.xxhash64("hashes"))


def _with_tokens(lines: DataFrame, n: int, common: list[int]) -> DataFrame:
    """The set of a line's shingle hashes, each led by how many common words the shingle has; rarest first."""
    hashes, count = F.col("hashes"), F.size("hashes")
    hashed = _hashed(lines)
    if common:  # the lowest bit says whether a word is common
        hashed = hashed.withColumn("hashes", F.transform(hashes, lambda h: F.when(
            _bucket(h).isin(common), h.bitwiseOR(1)).otherwise(h.bitwiseAND(-2))))

    def token(shingle: Column) -> Column:
        mixed = F.shiftrightunsigned(F.xxhash64(shingle), 4)
        if not common:
            return mixed
        known = shingle["0"].bitwiseAND(1)
        for k in range(1, n):
            known = known + shingle[str(k)].bitwiseAND(1)
        return mixed + F.shiftleft(known, 60)

    whole = F.array(F.shiftrightunsigned(F.xxhash64(hashes, count), 4))
    rows = F.arrays_zip(*[F.slice(hashes, k + 1, F.greatest(count - n + 1, F.lit(0))).alias(str(k)) for k in range(n)])
    return hashed.select("doc_id", "line", "whole", F.sort_array(F.array_distinct(
        F.when(count >= n, F.transform(rows, token)).otherwise(whole))).alias("tokens"))


def _least_overlap(x: Column) -> Column:
    """Rounded up; what floating point adds to a whole number does not count."""
    return F.ceil(x - F.lit(1e-9)).cast("int")


def _rarest_grams(lines: DataFrame, n: int, similarity: float, tiers: list[int]) -> DataFrame:
    """doc_id, line, whole, ``grams`` (hashes) and ``asks``: each of two similar lines of other words shares so many of its grams.

    The words of the lowest tier (by bucket) are taken until the shingles they are in are as many as the prefix filter
    asks for, and more. Words that a line has more than once are taken as they come, but their shingles, which may be
    the same, are not counted. A shingle holds the gram that begins with its taken word, or the one that ends with it;
    a gram is in n - gram + 1 shingles. Of two lines, that whose taken words end first shares all but n - ceil(0.8 n) of its
    shingles, and the other has taken their words, too. Lines with too few shingles to count take all words, and ask for one."""
    gram, words = (n + 2) // 2, F.size("hashes")
    count = words - n + 1
    tier = F.split(F.lit(",".join(str(t << 58) for t in tiers)), ",").cast("array<long>")
    placed = F.transform("hashes", lambda h, i: F.get(tier, _bucket(h)).bitwiseOR(
        F.shiftleft(F.shiftrightunsigned(h, 30), _PLACE_BITS)).bitwiseOR(i.cast("long")))
    needed = count - _least_overlap(count * F.lit(similarity)) + 1 + (SHARED_GRAMS - 1) * (n - gram + 1)
    ranked = _hashed(lines).withColumns({"ranked": F.when(count >= 1, F.sort_array(placed)), "needed": needed})

    def word(k: Column) -> Column:
        return F.coalesce(F.shiftright(F.get("ranked", k), _PLACE_BITS), F.lit(-1))

    def once(r: Column) -> Column:
        """Of the r rarest places, those of words that the line has once."""
        return F.filter(F.slice("ranked", F.lit(1), r), lambda _, k: (word(k) != word(k - 1)) & (word(k) != word(k + 1)))

    def place(s: Column) -> Column:
        return s.bitwiseAND(_PLACES).cast("int")

    def shingles(r: Column) -> Column:
        """How many shingles hold one of those places."""
        def add(seen: Column, at: Column) -> Column:
            new = F.least(at, count - 1) - F.greatest(at - (n - 1), seen["last"] + 1) + 1
            return F.struct(at.alias("last"), (seen["n"] + F.greatest(new, F.lit(0))).alias("n"))

        return F.aggregate(F.sort_array(F.transform(once(r), place)), F.struct(F.lit(-1).alias("last"), F.lit(0).alias("n")), add)["n"]

    least = F.ceil(F.col("needed") / F.lit(n)).cast("int")
    enough = F.when(words > _PLACES, F.lit(None).cast("int"))
    for r in (least, least + 1, 2 * least + 1, 4 * least + 2):
        enough = enough.when(shingles(r) >= F.col("needed"), r)
    taken = ranked.withColumn("r", F.when(F.col("ranked").isNotNull(), enough)).withColumn("cut", F.array_max(once(F.col("r"))))
    at = taken.withColumn("at", F.when(F.col("cut").isNull(), F.sequence(F.lit(0), words - 1)).otherwise(
        F.transform(F.filter(F.slice("ranked", F.lit(1), F.col("r")), lambda s: s <= F.col("cut")), place)))
    starts = F.concat(F.filter("at", lambda i: i <= words - gram), F.transform(
        F.filter("at", lambda i: i >= gram - 1), lambda i: i - (gram - 1)))
    of_words = F.transform(F.array_distinct(starts), lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(gram)]))
    return at.select("doc_id", "line", "whole", F.when(F.col("cut").isNull(), 1).otherwise(SHARED_GRAMS).alias("asks"), F.when(count >= 1, F.array_distinct(of_words)).otherwise(
        F.array().cast("array<long>")).alias("grams"))


def _bitmap(tokens: Column) -> list[Column]:
    """For each bit whether an odd number of the set's tokens have it: two sets differ in as many tokens at least as in bits."""
    def toggled(k: int):
        return lambda bits, t: F.when(F.shiftright(t, 6).bitwiseAND(BITMAP_LONGS - 1) == k, bits.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int")))).otherwise(bits)

    return [F.aggregate(tokens, F.lit(0).cast("long"), toggled(k)).alias(name) for k, name in enumerate(_BITS)]


def _sieved(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` without most of those whose key no wanted row has; a join settles the rest.

    The keys' hashes set bits of a bitmap of bounded size. The more keys, the more rows pass."""
    def cell(hashed: Column) -> Column:
        return hashed.bitwiseAND(SIEVE_LONGS - 1)

    def bit(hashed: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 32).bitwiseAND(63).cast("int"))

    hashed = F.xxhash64(wanted_key)
    sieve = wanted.groupBy(cell(hashed).alias("_cell")).agg(F.bit_or(bit(hashed)).alias("_set")).hint("broadcast")
    return (rows.withColumn("_hash", F.xxhash64(key)).withColumn("_cell", cell(F.col("_hash"))).join(sieve, "_cell")
            .where(F.col("_set").bitwiseAND(bit(F.col("_hash"))) != 0).select(*rows.columns))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, line) of pairs' lines that reach the similarity with (a_doc, a_line, a_whole)."""
    key, earlier = F.struct(*_LINE), F.struct("a_doc", "a_line", "a_whole")
    b = _sieved(sets.select(*_LINE, "tokens"), key, pairs, key)
    a = _sieved(sets.select(*_LINE, "tokens"), key, pairs, earlier).toDF("a_doc", "a_line", "a_whole", "a")
    shared = F.size(F.array_intersect("a", "tokens"))
    return (pairs.join(b, _LINE).join(a, ["a_doc", "a_line", "a_whole"])
            .where(shared >= (F.size("a") + F.size("tokens") - shared) * F.lit(similarity) - F.lit(1e-9))
            .select("doc_id", "line").distinct())


def similar_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                  similarity: float = SIMILARITY, common_share: float = COMMON_SHARE) -> DataFrame:
    """(doc_id, line): the lines, counted from 0, that an earlier line is similar to.

    Each step's shuffle files go when its table is written."""
    spark, name = docs.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return _similar_lines(docs, id_col, text_col, shingle_words, similarity, common_share)
    finally:
        spark.conf.set(name, before)


def _similar_lines(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, similarity: float, common_share: float) -> DataFrame:
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc_id"), _plain(F.col(text_col)).alias("text"))
    counts = (plain.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word")).where("word <> ''")
              .select(_bucket(F.xxhash64("word")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect())
    often = common_share * sum(r.n for r in counts)
    common = [r.bucket for r in counts if r.n > often]  # at most 1 / share
    tiers = [0] * WORD_BUCKETS
    for r in counts:
        tiers[r.bucket] = min(31, int(16 * r.n / often).bit_length())

    lines = plain.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "body")).where("trim(body) <> ''")
    worded = lines.select("doc_id", "line", _words(F.col("body")).alias("words"))
    # written, since the words are dear: read for the copies, and for the grams of two lines
    ranked = stored(_rarest_grams(worded, shingle_words, similarity, tiers), "prefix-tokens")
    named = ranked.select(*_LINE).repartition("whole")
    first = named.groupBy("whole").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    copies = stored(named.join(first, "whole").where("first < struct(doc_id, line)").select("doc_id", "line").distinct(), "line-copies")
    grams = ranked.select("whole", F.explode("grams").alias("gram")).where("gram is not null").repartition("gram")
    held = grams.groupBy("gram").agg(F.min("whole").alias("least"), F.max("whole").alias("most")).where("least <> most")
    near = stored(grams.join(held.select("gram").hint("shuffle_hash"), "gram", "left_semi").distinct()
                  .groupBy("whole").agg(F.count("*").alias("shares")), "near-lines")

    # whole lines are fetched once, for those that share enough grams; all but a few of the others stay where they are
    asked = stored(_sieved(ranked.select(*_LINE, "asks"), F.col("whole"), near, F.col("whole")).join(near, "whole").where("shares >= asks")
                   .groupBy("whole").agg(F.min(F.struct("doc_id", "line")).alias("first")).select("first.*").distinct(), "asked-lines")
    place = F.struct("doc_id", "line")  # and no semi join, which Spark would take below the sieve
    bodies = _sieved(lines, place, asked, place).join(asked, ["doc_id", "line"]).dropDuplicates()
    tokens = _with_tokens(bodies.select("doc_id", "line", _words(F.col("body")).alias("words")), shingle_words, common)
    sets = stored(tokens.select("*", *_bitmap(F.col("tokens"))), "line-bodies")
    sized = sets.withColumn("size", F.size("tokens"))
    prefix = F.col("size") - _least_overlap(F.col("size") * F.lit(similarity)) + 1
    row = [*_LINE, "size", "at", *_BITS]
    postings = sized.select(*_LINE, "size", *_BITS, F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("at", "token"))
    postings = postings.repartition("token")
    held = postings.groupBy("token").agg(F.min(F.struct(*row)).alias("first"), F.count("*").alias("n"))

    def may_reach(a: str) -> Column:
        """Whether a line and an earlier one of its prefix token, with ``a`` before its columns' names, may be similar: by place, size, place of the token, and bitmaps."""
        size, a_size = F.col("size"), F.col(f"{a}size")
        least = _least_overlap((size + a_size) * F.lit(similarity / (1 + similarity)))
        apart = sum((F.bit_count(F.col(k).bitwiseXOR(F.col(a + k))) for k in _BITS[1:]), F.bit_count(F.col(_BITS[0]).bitwiseXOR(F.col(a + _BITS[0]))))
        return ((F.struct(F.col(f"{a}doc_id"), F.col(f"{a}line")) < F.struct("doc_id", "line"))
                & (F.least(size, a_size) >= F.greatest(size, a_size) * F.lit(similarity) - F.lit(1e-9))
                & (F.least(size - F.col("at"), a_size - F.col(f"{a}at")) >= least) & (apart <= size + a_size - 2 * least))

    def pairs_of(rows: DataFrame, a: str) -> DataFrame:
        return rows.select(*_LINE, F.col(f"{a}doc_id").alias("a_doc"), F.col(f"{a}line").alias("a_line"), F.col(f"{a}whole").alias("a_whole")).distinct()

    # of a token that two lines hold, the first round sees the only pair
    shared = stored(postings.join(held.where("n > 1").hint("shuffle_hash"), "token")
                    .select("token", "n", *row, F.when(may_reach("first."), F.struct(*[F.col(f"first.{k}").alias(k) for k in _LINE])).alias("first"))
                    .where("n > 2 or first is not null"), "line-postings")
    firsts = stored(pairs_of(shared.where("first is not null"), "first."), "first-pairs")
    settled = stored(_verified(firsts, sets, similarity), "settled")
    many = shared.where("n > 2").select("token", *row)
    probe = many.join(settled, ["doc_id", "line"], "left_anti")
    earlier = many.select("token", *[F.col(k).alias(f"a_{k}") for k in row])
    pairs = pairs_of(probe.join(earlier, "token").where(may_reach("a_")), "a_")
    return copies.union(settled).union(stored(_verified(stored(pairs, "line-pairs"), sets, similarity), "verified")).distinct()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, removed_lines (their numbers, comma-joined, from 0)."""
    removed = (similar_lines(docs, id_col, text_col, **options).groupBy("doc_id")
               .agg(F.sort_array(F.collect_list("line")).alias("removed")))
    rows = docs.select(F.col(id_col).cast("long").alias("given"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc_id"),
                       F.size(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n")).cast("long").alias("n_lines"))
    numbers = F.filter("removed", lambda i: i < F.col("n_lines"))
    return rows.join(removed, "doc_id", "left").select(
        F.col("given").alias("doc_id"), "n_lines",
        F.coalesce(F.when(F.col("removed").isNotNull(), F.size(numbers)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform(numbers, lambda i: i.cast("string")), ","), F.lit("")).alias("removed_lines"))


def without_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of ``removed`` (doc_id, line) taken out of the text."""
    gone = removed.groupBy("doc_id").agg(F.collect_list("line").alias("_gone")).withColumnRenamed("doc_id", "_id")
    lines = F.split(F.col(text_col), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return (docs.join(gone, F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)) == F.col("_id"), "left")
            .withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(text)).select(*docs.columns))
