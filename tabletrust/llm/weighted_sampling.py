"""Document fingerprints by consistent weighted sampling.

A text is a bag of word n-grams, each weighted by its number of occurrences.
Each of ``samples`` positions of a fingerprint is the term that wins a draw
in which a term of weight w takes part with

    r, c ~ Gamma(2, 1),  beta ~ U(0, 1),  t = floor(ln(w) / r + beta),
    a = c * exp(-r * (t - beta + 1)),

all three fixed by the term and the position; the smallest ``a`` wins and
(term, t) is the sample.  Two bags give the same sample with a probability
that equals their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones.

The draws are made from the other end, which is the same law: for w = 1,
``a`` is exponential, y = exp(-r * beta) is uniform and independent of it,
and given ``a``, z = exp(r * (1 - beta)) exceeds 1 by an exponential of rate
``a``.  So a term of weight 1 needs one hash to compete, and only other
weights need r = ln(z / y), beta = -ln(y) / r and c = a * z.

All of it is DataFrame code: hashes and logarithms inside one generated
stage, minima combined in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.llm.common import group_key
from tabletrust.llm.ngram_join import text_key
from tabletrust.operators.numbering import number_rows

#: Scripts written without spaces: each of their characters is a word.
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\x{20000}-\x{3ffff}"
_BLANK = "[\\x20\\x09-\\x0D]+"
#: Terms of weight 1 that compete together.
CHUNK = 8
#: What a row holds: a chunk, one term for a position each, or no term.
ALL, EACH, NONE = -1, 0, -2
#: A sample is a long: 36 bits of how it competes, 27 bits of what it is.
TIE_BITS = 27
_SAME = (1 << TIE_BITS) - 1
_UNIT = float(1 << (63 - TIE_BITS))
#: Documents of a slab, whose neighbours are looked up in one window.
SLAB = 64
#: Equal rows that share a place in the order of documents.
EQUAL = 1024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def weighted_ngrams(text: Column, n: int = 5) -> Column:
    """The bag of a text: an array of (``term`` long, ``weight`` double), the
    hashes of its word n-grams and how often each occurs.  Lower case; a
    text of fewer than ``n`` words has one n-gram of all its words, one
    without words, or NULL, has none."""
    none = F.array().cast("array<struct<term:bigint,weight:double>>")

    def words(plain: Column) -> Column:
        apart = F.when(plain.rlike(f"[{UNSPACED}]"), F.regexp_replace(plain, f"([{UNSPACED}])", " $1 ")).otherwise(plain)
        return F.split(F.regexp_replace(apart, f"^{_BLANK}|{_BLANK}$", ""), _BLANK)

    def grams(w: Column) -> Column:
        # A NULL beyond the end leaves the hash as it is.
        at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - F.lit(n)))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))

    def counted(sorted_: Column) -> Column:
        def runs(starts: Column) -> Column:
            return F.transform(starts, lambda at, i: F.struct(
                F.get(sorted_, at).alias("term"), (F.coalesce(F.get(starts, i + 1), F.size(sorted_)) - at).cast("double").alias("weight")))

        return let(F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda i: (i == 0) | (F.get(sorted_, i) != F.get(sorted_, i - 1))), runs)

    def bag(g: Column) -> Column:
        once = F.transform(g, lambda t: F.struct(t.alias("term"), F.lit(1.0).alias("weight")))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), once).otherwise(let(F.sort_array(g), counted))

    def of(w: Column) -> Column:
        return F.when((F.size(w) == 1) & (F.get(w, F.lit(0)) == ""), none).otherwise(let(grams(w), bag))

    return let(let(F.lower(F.coalesce(text, F.lit(""))), words), of)


def _hash(term: Column, salt: Column) -> Column:
    return F.xxhash64(term.bitwiseXOR(salt))


def _uniform(h: Column) -> Column:
    return (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def with_draws(rows: DataFrame, name: str, term: Column, weight: Column, salt: Column) -> DataFrame:
    """``rows`` with ``name``: the sample of a term of any positive weight, a
    long that is smaller the better it competes.  NULL terms have none."""
    out = rows.withColumn("_h", F.when(term.isNotNull(), _hash(term, salt)))
    out = out.withColumn("_a", -F.log1p(-(F.shiftrightunsigned("_h", 1 + TIE_BITS) + F.lit(0.5)) / F.lit(_UNIT)))
    out = out.withColumn("_y", F.log(_uniform(F.xxhash64("_h", F.lit(1))))).withColumn("_z", F.log(F.lit(1.0) - F.log(_uniform(F.xxhash64("_h", F.lit(2)))) / F.col("_a")))
    out = out.withColumn("_r", F.col("_z") - F.col("_y")).withColumn("_b", -F.col("_y") / F.col("_r"))
    out = out.withColumn("_k", F.floor(F.log(weight) / F.col("_r") + F.col("_b")))
    # a = c * exp(-r * (t - beta + 1)), with c = a * z.
    least = F.col("_a") * F.exp(F.col("_z") - F.col("_r") * (F.col("_k") - F.col("_b") + F.lit(1.0)))
    place = F.least(F.floor(-F.expm1(-least) * F.lit(_UNIT)), F.lit((1 << (63 - TIE_BITS)) - 1))
    which = F.when(F.col("_k") == 0, F.col("_h")).otherwise(F.xxhash64("_h", F.col("_k") + F.lit(16)))
    sample = F.shiftleft(place.cast("bigint"), TIE_BITS).bitwiseOR(F.shiftrightunsigned(which, 1).bitwiseAND(F.lit(_SAME)))
    return out.withColumn(name, F.when(F.col("_h").isNotNull(), sample)).drop("_h", "_a", "_y", "_z", "_r", "_b", "_k")


def weighted_samples(bags: DataFrame, keys: list[str], samples: int = 64, seed: int = 1, bag: str = "bag") -> DataFrame:
    """One row per ``keys``: the samples of its bag as ``sig``, an array of
    ``samples`` longs that equal each other where (term, t) do, empty for a
    bag without terms.

    ``bags`` has one row per ``keys`` with ``bag``, an array of (``term``
    long, ``weight`` double), each term once.  Terms that are NULL or have a
    weight that is NULL or not above 0 do not count; a NULL bag is empty.
    """
    real = F.filter(F.coalesce(F.col(bag), F.array().cast("array<struct<term:bigint,weight:double>>")),
                    lambda x: x["term"].isNotNull() & (F.coalesce(x["weight"], F.lit(0.0)) > 0))

    def entry(kind: int, weight: Column, terms: list[Column]) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), F.coalesce(weight, F.lit(0.0)).alias("_w"),
                        *[F.coalesce(t, F.lit(0).cast("bigint")).alias(f"_t{k}") for k, t in enumerate(terms)])

    def competing(x: Column) -> Column:
        # Terms of weight 1 compete at all positions at once, by the chunk; others one by one.
        ones = F.transform(F.filter(x, lambda t: t["weight"] == 1), lambda t: t["term"])
        others = F.transform(F.filter(x, lambda t: t["weight"] != 1), lambda t: entry(EACH, t["weight"], [t["term"]] * CHUNK))

        def chunks(one: Column) -> Column:
            at = F.when(F.size(one) > 0, F.sequence(F.lit(0), F.size(one) - 1, F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda i: entry(ALL, F.lit(1.0), [F.coalesce(F.get(one, i + k), F.get(one, i)) for k in range(CHUNK)]))

        none = F.array(entry(NONE, F.lit(0.0), [F.lit(0).cast("bigint")] * CHUNK))
        return F.when(F.size(x) > 0, F.concat(let(ones, chunks), others)).otherwise(none)

    rows = bags.select(*keys, F.inline(let(real, competing)))
    rows = rows.withColumn("_j", F.explode(F.when(F.col("_kind") == EACH, F.sequence(F.lit(0), F.lit(samples - 1))).otherwise(F.array("_kind"))))
    rows = with_draws(rows, "_s", F.when(F.col("_j") >= 0, F.col("_t0")), F.col("_w"), F.xxhash64(F.lit(seed), "_j"))

    def least(j: int) -> Column:
        salt = F.xxhash64(F.lit(seed), F.lit(j))
        chunk = F.least(*[F.shiftrightunsigned(_hash(F.col(f"_t{k}"), salt), 1) for k in range(CHUNK)])
        return F.min(F.when(F.col("_j") == j, F.col("_s")).when(F.col("_j") == ALL, chunk)).alias(f"_m{j}")

    all_ = F.array(*[f"_m{j}" for j in range(samples)])
    return rows.groupBy(*keys).agg(*map(least, range(samples))).select(
        *keys, F.when(F.col("_m0").isNull(), F.array().cast("array<bigint>")).otherwise(all_).alias("sig"))


def fingerprint_text(sig: Column) -> Column:
    """A signature as text: seven hexadecimal digits for each sample."""
    return F.lower(F.array_join(F.transform(sig, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(_SAME))), 7, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of samples that two signatures have in common: an estimate
    of the generalised Jaccard similarity.  Two empty ones are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(same / F.size(a))


def fingerprints(docs: DataFrame, n: int = 5, samples: int = 64, seed: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``sig`` (the signature of its
    bag of word ``n``-grams) and ``fingerprint`` (the signature as text).
    NULL counts as the empty text, whose signature is empty."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("_at"), weighted_ngrams(F.col(text), n).alias("bag"))
    return weighted_samples(rows, ["doc_id", "_at"], samples, seed).select("doc_id", "sig", fingerprint_text(F.col("sig")).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, n: int = 5, samples: int = 64, seed: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    The edited text is the text with its last floor(n_chars / 4) code points
    replaced by the first as many of the next document (all, if it has
    fewer); the documents are in order of doc_id, the first follows the last.
    ``near_edited`` and ``near_next`` are the likenesses of the fingerprint
    to the edited text's and to the next document's.

    NULL texts are empty.  A NULL doc_id comes first; rows of one doc_id are
    in order of their texts' MD5.  Rows that repeat both follow each other,
    so all but the last of them have an equal text as the next document.  No
    rows give no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), group_key(F.col(doc_id)).alias("_id"),
                       text_key(F.col(text)).alias("_key"))
    counts = rows.groupBy("_id", "_key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("m"))
    # The last of equal rows has a place of its own, the others share some.
    places = counts.withColumn("c", F.explode(F.sequence(F.lit(0), F.ceil((F.col("m") - 1) / F.lit(EQUAL))))).withColumn(
        "c", F.ceil((F.col("m") - 1) / F.lit(EQUAL)) - F.col("c"))
    places = places.withColumn("times", F.when(F.col("c") == 0, F.lit(1)).otherwise(F.least(F.lit(EQUAL), F.col("m") - 1 - (F.col("c") - 1) * EQUAL)).cast("int"))
    placed = number_rows(places, ["doc_id", "_key", F.desc("c")], name="place", start=0).select("_id", "_key", "times", "place")
    total = placed.agg(F.max("place")).first()[0]
    if total is None:
        total = 0
    place = F.col("place")
    # The first of a slab is also the last one's neighbour in the slab before.
    guest = F.when((place % SLAB == 0) & (place > 0), F.struct(place.alias("at"), (F.floor(place / SLAB) - 1).alias("slab"), F.lit(True).alias("guest"))).when(
        place == 0, F.struct(F.lit(total + 1).cast("bigint").alias("at"), F.lit(total // SLAB).cast("bigint").alias("slab"), F.lit(True).alias("guest")))
    own = F.struct(place.alias("at"), F.floor(place / SLAB).alias("slab"), F.lit(False).alias("guest"))
    seats = placed.withColumn("s", F.explode(F.array_compact(F.array(own, guest)))).select("_id", "_key", "times", "s.*")
    texts = rows.dropDuplicates(["_id", "_key"]).join(seats, ["_id", "_key"]).drop("_id", "_key")
    slab = Window.partitionBy("slab").orderBy("at")
    chars = F.length("text")
    cut = F.floor(chars / 4).cast("int")
    texts = texts.withColumn("_next", F.lead("text").over(slab)).withColumn(
        "_edited", F.when(~F.col("guest"), F.concat(F.substring(F.col("text"), F.lit(1), chars - cut), F.substring(F.col("_next"), F.lit(1), cut))))
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")), F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("body")))
    each = texts.select("slab", "at", "guest", "times", "doc_id", chars.cast("bigint").alias("n_chars"), F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
                        F.explode(F.when(F.col("guest"), F.slice(both, 1, 1)).otherwise(both)).alias("b"))
    keys = ["slab", "at", "b.kind", "guest", "times", "doc_id", "n_chars", "edited_sha256"]
    bags = each.select(*keys, weighted_ngrams(F.col("b.body"), n).alias("bag"))
    keys[2] = "kind"
    sigs = weighted_samples(bags, keys, samples, seed)
    turn = Window.partitionBy("slab").orderBy("at", "kind")
    near = sigs.withColumn("_e", F.lead("sig", 1).over(turn)).withColumn("_n", F.lead("sig", 2).over(turn)).where((F.col("kind") == 0) & ~F.col("guest"))
    return near.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("sig")).alias("fingerprint"), fingerprint_text(F.col("_e")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("_e")).alias("near_edited"), likeness(F.col("sig"), F.col("_n")).alias("near_next"))
