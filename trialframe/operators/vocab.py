"""Names and rules: category cascade, condition keywords, vocabulary resolution."""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, rules

#: letters of all keywords of a rule table together
MAX_RULES = 5_000_000


def cascade_table(spark: SparkSession, table: Mapping[tuple[str, str, str], str | None]) -> DataFrame:
    """(c1, c2, c3, value) of a rule mapping."""
    return spark.createDataFrame([(*k, v) for k, v in table.items()], "c1 string, c2 string, c3 string, value string")


def rule_cascade(df: DataFrame, table: DataFrame, c1: str, c2: str, c3: str, into: str = "value") -> DataFrame:
    """``df`` with the value of the first rule present among (c1, c2, c3), (c1, c2, ''), (c1, '', '').

    A rule without a value still ends the search, so each level joins its own hit flag. The rule
    table is written by hand and small; it is broadcast.
    """
    out, picked = df, F
    keys = (F.coalesce(c1, F.lit("")), F.coalesce(c2, F.lit("")), F.coalesce(c3, F.lit("")))
    for level in (3, 2, 1):
        rule = table.filter(" AND ".join(["c3 = ''"] * (level < 3) + ["c2 = ''"] * (level < 2)) or "true")
        rule = rule.select(F.col("c1").alias(f"__a{level}"), F.col("c2").alias(f"__b{level}"), F.col("c3").alias(f"__c{level}"), F.col("value").alias(f"__v{level}"), F.lit(True).alias(f"__h{level}"))
        wanted = [k if i < level else F.lit("") for i, k in enumerate(keys)]
        on = [F.col(f"__{x}{level}") == w for x, w in zip("abc", wanted, strict=True)]
        out = out.join(F.broadcast(rule), on, "left")
        picked = picked.when(F.col(f"__h{level}"), F.col(f"__v{level}"))
    return out.withColumn(into, picked).select(*df.columns, into)


def category_diagnoses(trials: DataFrame, spark: SparkSession, key: str = "trial_key", categories: str = "categories") -> DataFrame:
    """(key, diagnoses): names of a trial's categories in order, each once."""
    items = trials.select(key, F.posexplode_outer(categories).alias("pos", "c")).select(key, "pos", "c.*")
    found = rule_cascade(items, cascade_table(spark, rules.CATEGORY_DIAGNOSIS), "cat1", "cat2", "cat3")
    return ordered_distinct(found, key, "pos", "value", "diagnoses")


def ordered_distinct(df: DataFrame, key: str, pos: str, value: str, into: str) -> DataFrame:
    """(key, into): the non-null values of a key in order of first appearance, each once."""
    rows = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(pos, value))))
    return df.groupBy(key).agg(F.array_distinct(F.transform(rows, lambda x: x[value])).alias(into))


def condition_diagnoses(conditions: Column) -> Column:
    """Names of conditions by keyword, in order, each once."""
    found = F.transform(conditions, lambda c: clean.first_keyword(c, rules.CONDITION_KEYWORDS))
    return F.array_distinct(F.array_compact(found))


def keyword_rules(df: DataFrame, text: str, rules: DataFrame, into: str = "value") -> DataFrame:
    """``df`` with the value of the first rule (pos, keyword, value) whose keyword is in the text in lower case; null without one, and where the rule has none.

    The table form of ``functions.clean.first_keyword`` for rules by the thousand: one automaton over all keywords passes each text once, however many there are. Of equal
    keywords the least ``pos`` counts, and an empty or null keyword never does. The rules are the caller's table; it is collected and sent to the executors, and refused beyond
    MAX_RULES letters. A null text has no rule; columns named like the result are replaced.
    """
    import ahocorasick

    listed = rules.filter(F.length("keyword") > 0).groupBy("keyword").agg(F.min(F.struct("pos", "value")).alias("r")).select("keyword", "r.*")
    if (listed.agg(F.sum(F.length("keyword"))).head()[0] or 0) > MAX_RULES:
        raise ValueError(f"keywords of over {MAX_RULES} letters together")
    found = sorted(listed.collect(), key=lambda r: r["pos"])
    values = [r["value"] for r in found]
    automaton = ahocorasick.Automaton()
    for place, r in enumerate(found):
        automaton.add_word(r["keyword"], place)
    automaton.make_automaton()
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    def first(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else min((place for _, place in shared.value.iter(t)), default=None) for t in texts], dtype="Int32")

    place = F.pandas_udf(first, "int")(F.lower(F.col(text).cast("string"))) if found else F.lit(None).cast("int")
    kept = [c for c in df.columns if c != into]
    table = df.sparkSession.createDataFrame(list(enumerate(values)), f"__place int, __value {rules.schema['value'].dataType.simpleString()}")
    return df.withColumn("__place", place).join(F.broadcast(table), "__place", "left").select(*kept, F.col("__value").alias(into))


def resolve(names: DataFrame, vocabulary: DataFrame, name: str = "name", corrections: Mapping[str, str | None] | None = None, cutoff: float = 0.85) -> DataFrame:
    """``names`` with ``resolved``: the name if the vocabulary has it, else its correction (none: dropped), else
    the closest vocabulary name at ``cutoff`` or more, else null. A leading ``!`` is kept.

    The fuzzy step (``closest``) sees distinct unresolved names only and joins them with the vocabulary by pairs of letters, never all with all.
    The corrections are written by hand and small.
    """
    spark = names.sparkSession
    table = spark.createDataFrame(list((rules.NAME_CORRECTIONS if corrections is None else corrections).items()), "raw string, corrected string")
    raw = F.when(F.col(name).startswith("!"), F.substring(name, 2, 2**31 - 1)).otherwise(F.col(name))
    keyed = names.withColumn("__raw", raw)
    known = vocabulary.select(F.col("name").alias("__raw")).distinct().withColumn("__known", F.lit(True))
    fixed = F.broadcast(table.select(F.col("raw").alias("__raw"), F.col("corrected").alias("__corrected"), F.lit(True).alias("__fix")))
    open_names = keyed.select("__raw").filter("__raw IS NOT NULL").distinct().join(known, "__raw", "left_anti").join(fixed, "__raw", "left_anti")
    close = closest(open_names.withColumnRenamed("__raw", "name"), vocabulary.select("name").distinct(), cutoff)
    close = close.select(F.col("name").alias("__raw"), F.col("match").alias("__close"))
    joined = keyed.join(known, "__raw", "left").join(fixed, "__raw", "left").join(close, "__raw", "left")
    plain = F.when(F.col("__known"), F.col("__raw")).when(F.col("__fix"), F.col("__corrected")).otherwise(F.col("__close"))
    resolved = F.when(F.col(name).startswith("!"), F.concat(F.lit("!"), plain)).otherwise(plain)
    return joined.withColumn("resolved", resolved).select(*names.columns, "resolved")


def letter_pairs(names: DataFrame) -> DataFrame:
    """(name, gram): every two neighbouring letters of each name (the name itself if it has one), repeats numbered, as fingerprints."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("name") - 1, F.lit(1))), lambda i: F.substring("name", i, F.lit(2)))
    found = names.select("name", F.explode(pairs).alias("pair")).groupBy("name", "pair").agg(F.count("*").cast("int").alias("times"))
    return found.select("name", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth"), "pair").select("name", F.xxhash64("pair", "nth").alias("gram"))


def _need(letters: Column, cutoff: float) -> Column:
    """How many pairs of neighbouring letters two names of so many letters together share at least, if their ratio reaches the cutoff.

    The ratio is 2 m / s. The m matched letters stand in blocks, and between two blocks there is one of the s - 2 m unmatched ones, so there are s - 2 m + 1
    blocks at most, and a block of k letters has k - 1 pairs.
    """
    return F.ceil((1.5 * cutoff - 1) * letters - 1 - 1e-9).cast("int")


def _ranked(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, grams): the pairs of letters of each name, those of few names first."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "gram"))), lambda x: x["gram"])
    return grams.join(counts, "gram").groupBy("name").agg(ordered.alias("grams"))  # as long as a name


def _signatures(named: DataFrame, cutoff: float) -> DataFrame:
    """(name, size, signature, rank): what a name's partners must share with it.

    Of two lists of which ``need`` are common, the first two common ones are among the first n - need + 2 of both, so these make signatures two by
    two; where one common pair is enough, the first n - need + 1 do so alone. ``rank`` is the place of the first one.
    """
    named = named.withColumn("size", F.length("name"))
    least = _need(F.col("size") + F.ceil(F.col("size") * cutoff / (2 - cutoff) - 1e-9), cutoff)
    two = F.slice("grams", 1, F.greatest(F.size("grams") - F.greatest(least, F.lit(2)) + 2, F.lit(0)))
    one = F.slice("grams", 1, F.size("grams") - F.greatest(least, F.lit(1)) + 1)
    signature = lambda a, b, i: F.struct(F.xxhash64(a, b).alias("signature"), (i + 1).alias("rank"))
    both = F.flatten(F.transform(two, lambda a, i: F.transform(F.slice(two, i + 2, F.size(two)), lambda b: signature(a, b, i))))
    alone = F.when(least <= 1, F.transform(one, lambda a, i: signature(a, F.lit(""), i))).otherwise(F.array().cast("array<struct<signature:bigint,rank:int>>"))
    return named.select("name", "size", F.explode(F.concat(both, alone)).alias("s")).select("name", "size", "s.*")


def closest(names: DataFrame, vocabulary: DataFrame, cutoff: float = 0.85) -> DataFrame:
    """(name, match, ratio): the vocabulary name most like each name, if at ``cutoff`` or more; ties to the greater name.

    An exact similarity join on pairs of neighbouring letters: names meet by signatures of rare pairs, stay if what can follow
    the signature's first pair is enough, and if their common pairs are; only then the ratio is taken. Names of so few letters that no
    common pair is certain, and cutoffs of up to 2 / 3, are compared by length. Null and empty names have no match.
    """
    names, vocabulary = (df.select("name").filter(F.length("name") > 0).distinct() for df in (names, vocabulary))
    own, other = letter_pairs(names), letter_pairs(vocabulary)
    counts = own.unionByName(other).groupBy("gram").agg(F.count("*").alias("n"))
    own, other = _ranked(own, counts), _ranked(other, counts)
    right = _signatures(other, cutoff).select(F.col("name").alias("match"), F.col("size").alias("other_size"), "signature", F.col("rank").alias("other_rank"))
    together = F.col("size") + F.col("other_size")
    # what follows the first common pair, that one included, is enough in both
    follows = F.least(F.col("size") - F.col("rank"), F.col("other_size") - F.col("other_rank")) >= _need(together, cutoff)
    fits = (2 * F.least("size", "other_size") >= cutoff * together - 1e-9) & follows
    pairs = _signatures(own, cutoff).join(right, "signature").filter(fits).select("name", "match").distinct()
    pairs = pairs.join(own, "name").join(other.select(F.col("name").alias("match"), F.col("grams").alias("others")), "match")
    pairs = pairs.filter(F.size(F.array_intersect("grams", "others")) >= _need(F.length("name") + F.length("match"), cutoff)).select("name", "match")

    # names that may be alike without a common pair
    size = F.length("name")
    high = F.floor(size * (2 - cutoff) / cutoff + 1e-9).cast("int")
    low = F.ceil(size * cutoff / (2 - cutoff) - 1e-9).cast("int")
    near = names.select("name", F.explode(F.sequence(F.greatest(low, F.lit(1)), F.greatest(high, F.lit(1)))).alias("size")).filter(_need(size + F.col("size"), cutoff) <= 0)
    near = near.join(vocabulary.select(F.col("name").alias("match"), F.length("name").alias("size")), "size").select("name", "match")

    @F.pandas_udf("double")
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        matcher = difflib.SequenceMatcher()
        for name, match in batches:
            out = []
            for a, b in zip(name, match, strict=True):
                matcher.set_seq2(a)
                matcher.set_seq1(b)
                fast = matcher.real_quick_ratio() >= cutoff and matcher.quick_ratio() >= cutoff
                out.append(matcher.ratio() if fast else 0.0)
            yield pd.Series(out, dtype=float)

    scored = pairs.unionByName(near).distinct().withColumn("ratio", ratio("name", "match")).filter(F.col("ratio") >= cutoff)
    best = scored.groupBy("name").agg(F.max_by(F.struct("match", "ratio"), F.struct("ratio", "match")).alias("b"))
    return best.select("name", "b.match", "b.ratio")
