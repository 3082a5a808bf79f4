"""Secret scanning: fixed patterns and character Markov models.

Patterns find assignments, access keys and hexadecimal runs.  Beyond them,
every long run of token characters is scored by two first-order character
Markov models, one of random strings and one of ordinary identifiers: the
log-likelihood ratio decides.  The models are transition counts over labelled
strings: ordinary ones are identifiers in camel, snake, constant, kebab and path form, made of the neighbouring words of
all documents, numbers, dates and UUIDs; random ones are Base64 text and alphanumeric runs of digests.
Identifiers from more than ``NAME_DOCS`` documents weigh as much as those of so many, so that generated strings keep their share.
A quarter of the strings is held out of the counts; the threshold is the mean ratio that all but a thousandth of
the held-out ordinary ones stay below, though never below zero.

All work on texts is DataFrame functions inside the row: positions come from
the lengths of a split's gaps and matches.  One pass over the texts writes the
spans and candidates, which are scored.  Training reads the texts twice, for the counts and for the threshold; identifiers are
counted as they are made and never stored.  The driver holds one table of transition weights, fixed by the alphabet.

Defined cases: null text is empty and has no spans; without words in any document the ordinary strings are
numbers, dates and UUIDs; repeated rows give equal rows; a run with fewer than ``MIN_DISTINCT`` different
characters (a rule, a row of signs) is no candidate; spans of very long texts are found over the
whole text; other columns may have any names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, written

# The patterns of the base kinds.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("passw", "secret", "token", "api")  # in lower case, every assignment holds one
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 characters or more; a run that is shorter holds no other match
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGN = 12
KINDS = ("assign", "access", "hex", "markov")

MIN_CANDIDATE = 16       # characters
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{MIN_CANDIDATE},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_DISTINCT = 8
CODES = 2 ** 21          # more than there are code points
PIECE = 5                # characters of a string that are counted together
WORD = r"[A-Za-z]{2,12}"
WORDS_A_NAME = 3         # neighbouring words that make an identifier
NAME_DOCS = 4000         # documents, about, as whose the identifiers of all documents weigh
RANDOM_SAMPLES = 8000    # generated random strings
NUMBER_SAMPLES = 2000    # numbers, dates and UUIDs each
HELD_OUT = 4             # one sample of so many is held out, for the threshold
FALSE_POSITIVES = 0.001  # of the held-out ordinary samples
SMOOTHING = 1.0
SPAN = "struct<start:int,end:int,kind:string,value:string>"


def pattern_spans(text: Column, pattern: str, kind: str, min_group2: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points."""
    none = F.array().cast(f"array<{SPAN}>")

    def spans(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        group = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if min_group2 else found
        each = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), F.arrays_zip(found.alias("m"), group.alias("g")),
                          lambda gap, m: F.struct(F.length(gap).alias("gap"), m["m"].alias("m"), m["g"].alias("g")))
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

        def add(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + F.length(x["m"])
            one = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["g"].alias("value"))
            keep = F.length(x["g"]) >= min_group2
            return F.struct(end.alias("at"),
                            F.when(keep, F.concat(acc["spans"], F.array(one))).otherwise(acc["spans"]).alias("spans"))

        return F.when(F.size(gaps) <= 1, none).otherwise(F.aggregate(each, start, add, lambda acc: acc["spans"]))

    return let(F.split(text, pattern, -1), spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, base, candidates): spans of the patterns, and of token runs that touch none of them.

    ``digest`` is the text's; rows equal in id and digest have the same spans.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("doc_id"), F.md5(F.col(text_col)).alias("digest"),
        F.when(let(F.lower(text), lambda low: reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in ASSIGN_WORDS])),
               pattern_spans(text, ASSIGN, "assign", MIN_ASSIGN)).otherwise(F.array().cast(f"array<{SPAN}>")).alias("a"), pattern_spans(text, ACCESS, "access").alias("k"),
        pattern_spans(text, HEX, "hex").alias("h"), pattern_spans(text, CANDIDATE, "markov").alias("c"))
    return found.select(
        "doc_id", "digest", F.concat("a", "k", "h").alias("base"),
        let(F.concat("a", "k", "h"), lambda base: F.filter(
            F.col("c"), lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
            & (F.size(F.array_distinct(F.split(c["value"], ""))) >= MIN_DISTINCT))
        ).alias("candidates"))


def train(samples: DataFrame, part: int = 1) -> list[float]:
    """Log-likelihood ratio of each transition from (value, kind): a table of |alphabet|^2 numbers; ``part`` names weigh as one string."""
    def code(at: Column) -> Column:
        return F.ascii(F.substring(F.col("piece"), at, F.lit(1))).cast("long")

    # strings are cut into short pieces that share one character, which are counted first: they repeat as pairs do and are fewer
    kinds = F.when(F.col("kind") == "name", 0).when(F.col("kind") == "random", 1).otherwise(2).cast("long")
    cuts = samples.select(kinds.alias("kind"), "value", F.explode(F.sequence(F.lit(1), F.length("value") - 1, F.lit(PIECE - 1))).alias("i"))
    pieces = cuts.select("kind", F.substring("value", F.col("i"), F.lit(PIECE)).alias("piece")).groupBy("kind", "piece").agg(F.count(F.lit(1)).alias("n"))
    each = pieces.select("kind", "piece", "n", F.explode(F.sequence(F.lit(1), F.length("piece") - 1)).alias("i"))
    pairs = each.select(((F.col("kind") * CODES + code(F.col("i"))) * CODES + code(F.col("i") + 1)).alias("pair"), "n")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()  # at most 3 * |alphabet|^2 rows
    n = {}
    for r in counts:
        kind, first, second = r["pair"] // CODES ** 2, r["pair"] // CODES % CODES, r["pair"] % CODES
        key = (kind == 1, chr(first) + chr(second))
        n[key] = n.get(key, 0) + (r["n"] / part if kind == 0 else r["n"])
    weights = []
    for a in ALPHABET:
        total = {k: sum(n.get((k, a + b), 0) for b in ALPHABET) + SMOOTHING * len(ALPHABET) for k in (True, False)}
        weights += [math.log((n.get((True, a + b), 0) + SMOOTHING) / total[True])
                    - math.log((n.get((False, a + b), 0) + SMOOTHING) / total[False]) for b in ALPHABET]
    return weights


def mean_llr(value: Column, weights: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's transitions (alphabet characters only)."""
    table = F.lit(weights)

    def ratio(codes: Column) -> Column:
        total = F.aggregate(F.sequence(F.lit(1), F.size(codes) - 1), F.lit(0.0), lambda s, i: s + F.get(
            table, F.get(codes, i - 1) * len(ALPHABET) + F.get(codes, i)))
        return total / (F.size(codes) - 1)

    return let(codes_of(value), ratio)


def codes_of(value: Column) -> Column:
    """Position of each character in the alphabet."""
    places = F.lit([ALPHABET.find(chr(c)) for c in range(128)])
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.get(places, F.ascii(F.substring(value, i, F.lit(1)))))


def random_samples(spark: SparkSession) -> DataFrame:
    """(value, kind): Base64 text and alphanumeric, upper-case or lower-case runs of digests, of 16 to 43 characters."""
    base = F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256)))
    alnum = F.translate(base, "+/=", "")
    form = F.element_at(F.array(F.translate(base, "=", ""), alnum, alnum, F.upper(alnum), F.lower(alnum)), (F.col("id") % 5 + 1).cast("int"))
    return spark.range(RANDOM_SAMPLES).select(F.substring(form, F.lit(1), (16 + F.col("id") % 28).cast("int")).alias("value"), F.lit("random").alias("kind"))


def names(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(value, kind): an identifier of each word of the texts and its next ones, in the forms of programs and paths."""
    w = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    # texts without words leave after the words are placed: a filter on the array, also one that Spark infers, finds all words anew
    each = docs.select(w.alias("w")).select("w", F.posexplode_outer("w").alias("i", "first")).where("first IS NOT NULL")
    parts = [F.col("first"), *[F.get("w", F.col("i") + k) for k in range(1, WORDS_A_NAME)]]  # null past the end
    titles = F.concat_ws("", *[F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1000)) for p in parts])
    snake, path = F.concat_ws("_", *parts), F.concat_ws("/", *parts)
    forms = [snake, F.upper(snake), F.concat_ws("-", *parts), path, titles,
             F.concat(F.lower(F.substring(titles, 1, 1)), F.substring(titles, 2, 1000)), F.concat(path, F.lit("/"), titles)]
    value = forms[-1]
    for k, form in reversed(list(enumerate(forms[:-1]))):  # a name in one form, by its place; the others are not made
        value = F.when(F.col("i") % len(forms) == k, form).otherwise(value)
    # exploded, so that filters on the value do not make it anew
    return each.select(F.explode(F.array(value)).alias("value"), F.lit("name").alias("kind"))


def number_samples(spark: SparkSession) -> DataFrame:
    """(value, kind): numbers, dates and UUIDs."""
    digest = F.md5(F.concat(F.lit("n"), F.col("id").cast("string")))
    uuid = F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    number = F.substring(F.translate(F.sha2(F.col("id").cast("string"), 512), "abcdef", ""), 1, 24)
    day = F.date_format(F.timestamp_seconds(F.col("id") * 7654321 % 2000000000), "yyyy-MM-dd-HH-mm-ss")
    return spark.range(NUMBER_SAMPLES).select(F.explode(F.array(uuid, F.upper(uuid), number, day)).alias("value"), F.lit("number").alias("kind"))


def split_samples(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(value, kind) of all strings: those that are counted, and those held out."""
    spark = docs.sparkSession
    samples = random_samples(spark).unionByName(number_samples(spark)).unionByName(names(docs, text_col)).where(F.length("value") >= 2)
    held = F.pmod(F.xxhash64("value", F.lit(1)), F.lit(HELD_OUT)) == 0
    return samples.where(~held), samples.where(held)


def fitted(docs: DataFrame, text_col: str = "text") -> tuple[list[float], float]:
    """The transition weights and the threshold, chosen on held-out strings as long as a candidate may be."""
    part = max(1, docs.count() // NAME_DOCS)
    counted, held = split_samples(docs, text_col)
    weights = train(counted, part)
    apart = held.where("kind <> 'random'").where(F.length("value") >= MIN_CANDIDATE)
    ratios = apart.select("kind", mean_llr(F.col("value"), weights).alias("ratio"))
    # a number counts as often as `part` names, as it does in the weights
    times = F.when(F.col("kind") == "number", F.array_repeat("ratio", part)).otherwise(F.array("ratio"))
    at = ratios.select(F.explode(times).alias("ratio")).select(
        F.percentile_approx("ratio", 1 - FALSE_POSITIVES, 10000)).first()[0]
    return weights, max(0.0, at or 0.0)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, base, spans): spans of the base kinds, and all with those the models add, by start and kind."""
    found = written(scan(docs, id_col, text_col), "secret-spans")
    weights, threshold = fitted(docs.select(text_col), text_col)
    added = F.filter("candidates", lambda c: mean_llr(c["value"], weights) > threshold)
    order = F.array(*[F.lit(k) for k in KINDS])

    def by_start(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"),
                                                      s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
        return F.sort_array(keyed)

    return found.select("doc_id", "digest", by_start(F.col("base")).alias("base"), by_start(F.concat("base", added)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``, in each row those of its own text, whatever ids repeat."""
    found = secrets(docs, id_col, text_col).where(F.size("spans") > 0).dropDuplicates(["doc_id", "digest"])
    hits = found.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("spans").alias("_spans"))

    def cut(text: Column, spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
            return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out"))
                          ).otherwise(F.struct(F.greatest(s["end"], acc["at"]).alias("at"), acc["out"].alias("out")))

        return F.aggregate(spans, start, step,
                           lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))

    # the row travels whole in one column, so no name of its own columns clashes
    packed = docs.select(F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("digest"), F.struct("*").alias("row"))
    joined = packed.join(hits, packed.id.eqNullSafe(hits["_id"]) & (packed.digest == hits["_digest"]), "left")
    text = F.col("row")[text_col]
    clean = F.when(F.col("_spans").isNull(), text).otherwise(cut(text, F.col("_spans")))
    return joined.select(*[clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
