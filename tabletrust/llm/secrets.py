"""Secret scan: patterns, and a battery of randomness tests.

Base spans come from patterns: values assigned to secret names, access key
ids and long hexadecimal runs.  Other long tokens are tested for looking
like random output rather than like text.  The encoding of a token
(decimal, letters, hexadecimal, base 32, 62 or 64) fixes its alphabet, and
three one-sided tests give p-values under the null hypothesis "ordinary
text":

* chi-squared uniformity: symbols repeat as often as letters of a text do
  (rate 0.066, or 1.6 times the uniform rate for small alphabets), tested
  against more even use;
* runs: lower case, upper case, digits and signs alternate as in ordinary
  identifiers (30 % of the steps), tested against more runs;
* serial correlation of neighbouring symbols at least 0.5 in size (as in
  sequences and repeats), tested against less.

Stouffer's method combines them: their normal scores are added, so that a
token which one test finds to be text needs much from the others.  Short tokens carry little evidence and long
ones much, so false discoveries are controlled (Benjamini-Hochberg at
``rate``) within each class of lengths (powers of two), over all tokens of
the table.  P-values are rounded up to 1/20 of a decimal order, so a class
is ranked by a small histogram.

Everything is a DataFrame expression; texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.llm.common import cut_lineage

#: Case is Unicode's: the long s, the Kelvin sign and the i with and without
#: a dot are letters of the pattern in another case.
ASSIGN = r"""(?iu)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Maximal runs, as the plain patterns find them before the length test.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
SIGNS = "A-Za-z0-9+/_=-"
#: Longer tokens are tested; shorter ones cannot be told from text.
LEAST_TOKEN = 20
BINS = 20


def running(lengths: Column) -> Column:
    """Exclusive prefix sums of an array, in slices of 256: a slice is
    summed by appending, and the slices' sums in the same way."""
    zero = F.array(F.lit(0).cast("bigint"))

    def sums(xs: Column) -> Column:
        return F.aggregate(xs, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    starts = F.sequence(F.lit(1).cast("bigint"), F.size(lengths).cast("bigint"), F.lit(256).cast("bigint"))
    slices = F.transform(starts, lambda at: F.slice(lengths, at.cast("int"), F.lit(256)))
    wholes = F.transform(slices, lambda s: F.aggregate(s, F.lit(0).cast("bigint"), lambda acc, x: acc + x))
    return F.flatten(F.zip_with(slices, F.slice(sums(wholes), 1, F.size(slices)),
                                lambda s, before: F.transform(F.slice(sums(s), 1, F.size(s)), lambda v: v + before)))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array of struct(start, end, token): the leftmost non-overlapping
    matches' ``group`` (0, or one that ends its match), in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))
    steps = F.zip_with(gaps, found, lambda g, m: g + F.coalesce(F.length(m), F.lit(0)))
    # The sum of all before the next gap is where a match ends.
    ends = F.slice(running(steps), 2, F.size(found))
    taken = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    spans = F.zip_with(ends, taken, lambda e, t: F.struct((e - F.length(t)).alias("start"), e.alias("end"), t.alias("token")))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,token:string>>"))


def with_log_tail(rows: DataFrame, z: Column, name: str) -> DataFrame:
    """Adds ``name``: the log of the upper tail of the normal distribution
    at ``z`` (a rational approximation, error below 1e-7; its exponential
    factor keeps far tails in order)."""
    rows = rows.withColumn("_z", z).withColumn("_t", 1 / (1 + 0.2316419 * F.abs("_z")))
    t = F.col("_t")
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    rows = rows.withColumn("_p", F.greatest(F.exp(-F.col("_z") * F.col("_z") / 2) * 0.3989422804014327 * poly, F.lit(1e-290)))
    return rows.withColumn(name, F.log(F.when(F.col("_z") >= 0, F.col("_p")).otherwise(1 - F.col("_p"))))


def tested(tokens: DataFrame) -> DataFrame:
    """Adds ``n``, ``encoding``, ``p`` and its ``bin`` to rows with a
    ``token``."""
    token = F.col("token")
    core = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    rows = tokens.withColumn("core", core).withColumn("n", F.length("core").cast("double")).withColumn(
        "encoding",
        F.when(F.col("core").rlike("^[0-9]*$"), "decimal").when(F.col("core").rlike("^([a-z]+|[A-Z]+|[A-Z][a-z]+)$"), "letters")
        .when(F.col("core").rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(F.col("core").rlike("^[A-Z2-7]+$"), "base32")
        .when(F.col("core").rlike("^[A-Za-z0-9]+$"), "base62").otherwise("base64"))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = {"decimal": digits, "letters": lower, "hex": digits + "abcdef", "base32": upper + "234567",
                 "base62": upper + lower + digits, "base64": upper + lower + digits + "+/"}
    alphabet = F.create_map(*[F.lit(x) for kv in alphabets.items() for x in kv])[F.col("encoding")]
    folded = F.when(F.col("encoding").isin("letters", "hex"), F.lower("core")).otherwise(F.col("core"))
    rows = rows.withColumn("alphabet", alphabet).withColumn("folded", folded).withColumn("a", F.length("alphabet").cast("double"))
    rows = rows.withColumn("x", F.expr("transform(split(folded, ''), c -> cast(instr(alphabet, c) as double))"))
    rows = rows.withColumn("same", F.expr(
        "aggregate(array_distinct(split(folded, '')), 0D, (s, c) -> s + (n - length(replace(folded, c, ''))) * (n - length(replace(folded, c, '')) - 1))"))
    # Uniformity: the rate at which two symbols agree.
    text_rate = F.greatest(F.lit(0.066), 1.6 / F.col("a"))
    agree = F.col("same") / (F.col("n") * (F.col("n") - 1))
    spread = F.sqrt(2 * text_rate * (1 - text_rate)) / F.col("n")
    # Runs of character classes; letters of one case are vowels or others,
    # which words alternate and random letters, with few vowels, do not.
    classes = "transform(split(core, ''), c -> case when encoding = 'letters' then if(instr('aeiou', lower(c)) > 0, 1, 2) when c between 'a' and 'z' then 1 when c between 'A' and 'Z' then 2 when c between '0' and '9' then 3 else 4 end)"
    rows = rows.withColumn("classes", F.expr(classes)).withColumn("changes", F.expr(
        "aggregate(zip_with(slice(classes, 2, size(classes) - 1), slice(classes, 1, size(classes) - 1), (p, q) -> cast(p <> q as int)), 0, (s, d) -> s + d)"))
    rows = rows.withColumn("mean", F.expr("aggregate(x, 0D, (s, v) -> s + v) / n")).withColumn(
        "var", F.expr("aggregate(x, 0D, (s, v) -> s + (v - mean) * (v - mean))")).withColumn(
        "cov", F.expr("aggregate(zip_with(slice(x, 2, size(x) - 1), slice(x, 1, size(x) - 1), (p, q) -> (p - mean) * (q - mean)), 0D, (s, v) -> s + v)"))
    serial = F.when(F.col("var") > 0, F.abs(F.col("cov") / F.col("var"))).otherwise(F.lit(1.0))
    steps = F.col("n") - 1
    even = (text_rate - agree) / spread
    mixed = F.when(F.col("encoding") == "letters", (0.5 * steps - F.col("changes")) / F.sqrt(steps * 0.25)).otherwise(
        (F.col("changes") - 0.3 * steps) / F.sqrt(steps * 0.3 * 0.7))
    free = (0.5 - serial) * F.sqrt("n")
    rows = with_log_tail(rows, (even + mixed + free) / F.sqrt(F.lit(3.0)), "log_p")
    log10_p = -F.col("log_p") / F.log(F.lit(10.0))
    enough = F.col("n") >= LEAST_TOKEN
    return rows.withColumn("bin", F.when(enough, F.least(F.lit(300 * BINS), F.greatest(F.lit(0), F.floor(log10_p * BINS)))).otherwise(F.lit(0)).cast("int")).select(
        *tokens.columns, "n", "encoding", F.pow(F.lit(10.0), -F.col("bin") / BINS).alias("p"), "bin")


def secret_spans(docs: DataFrame, rate: float = 0.01, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``spans``,
    arrays of struct(start, kind, end, name), ascending: positions in code
    points, end exclusive.  ``spans`` has the base spans and those of
    random tokens (kind 3) that no base span overlaps.

    NULL text counts as empty; a text without secrets has empty arrays.
    Repeated rows get equal answers; no rows give no rows; other columns are
    ignored.
    """
    value = F.coalesce(F.col("_text"), F.lit(""))

    def kind(spans: Column, k: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), F.lit(KINDS[k]).alias("name")))

    # Tokens are looked for between the assignments only, and a token with
    # one of the other patterns in it overlaps a base span.
    gap_starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(F.col("_all"), lambda s: s["end"]))
    word = f"(?<![{SIGNS}])[{SIGNS}]{{{LEAST_TOKEN},}}"
    between = F.zip_with(F.split(value, ASSIGN, -1), gap_starts, lambda g, at: F.when(
        g.rlike(word), F.transform(matches(g, word), lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["token"].alias("token")))
    ).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,token:string>>")))
    scanned = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
        .withColumn("_all", matches(value, ASSIGN, 2))
        .select("doc_id", F.monotonically_increasing_id().alias("_row"),
                F.array_sort(F.concat(kind(F.filter("_all", lambda s: F.length(s["token"]) >= 6), 0), kind(matches(value, ACCESS), 1), kind(matches(value, HEX), 2))).alias("base"),
                F.filter(F.flatten(between), lambda s: ~s["token"].rlike(f"{ACCESS}|{HEX}")).alias("_tokens"))
    )
    scanned = cut_lineage(scanned)
    tokens = tested(scanned.select("_row", F.explode("_tokens").alias("s")).select("_row", "s.*")).withColumn(
        "class", F.floor(F.log2("n")).cast("int")).select("_row", "start", "end", "class", "bin")
    tokens = cut_lineage(tokens)
    # Benjamini-Hochberg within a class, over its histogram of p-values.
    bins = tokens.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    per_class = Window.partitionBy("class")
    ranked = bins.withColumn("rank", F.sum("n").over(per_class.orderBy(F.desc("bin")))).withColumn("m", F.sum("n").over(per_class))
    cuts = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / BINS) <= rate * F.col("rank") / F.col("m")).groupBy("class").agg(F.min("bin").alias("cut"))
    random = (
        tokens.join(cuts, "class").where(F.col("bin") >= F.col("cut"))
        .groupBy("_row").agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end", F.lit("random").alias("name"))).alias("random"))
    )
    more = F.coalesce("random", F.array().cast(scanned.schema["base"].dataType))
    return scanned.join(random, "_row", "left").select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")
