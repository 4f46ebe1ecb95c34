"""URL filter: rules, and for the rest the ratio of two character language models.

Rules give a host and a path prefix; a rule fits its host and all subdomains, and the
longest that fits decides (of equally long ones, the one that sorts last).  Rules are a table, of any size, that the
hosts' suffixes are joined to.  URLs that a rule accepts and URLs that a rule rejects train two
variable-order Markov models over characters: the probability after each context interpolates with that
after the next shorter one (Dirichlet weight ``WEIGHT``), from order ``ORDER`` down to single characters.  A URL
without a rule is allowed if its log-likelihood difference a character is at least a threshold, calibrated on held-out
URLs that have a rule: the one with the best balanced accuracy.

All of it is DataFrame operations.  Counts cover all URLs that have a rule outside the held-out fold.
A symbol is a character of any script (ASCII in lower case) and a context is keyed by its own characters, at every
order, so the model grows with the input.  Ratios are computed once for each distinct gram (a context and the symbol after it) of the
URLs; each table that is joined is broadcast if its measured size allows, and shuffled otherwise.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule, and the verdict of an empty text
(score 0).  Repeated rows get equal results.  Without any rule's URLs all scores are 0 and the threshold is 0.
Columns that clash with added ones are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import Table, scratch, shuffle_partitions

ORDER = 5
WEIGHT = 8.0
FOLDS = 5
#: Calibration bins a unit of score; scores are cut to +-4 for it.
BINS = 250
#: Scores are sums of whole billionths, so they do not depend on the order of rows.
UNIT = 1e9
#: Stands before and after a text.
_PAD = "\0"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and all that follows ``://``; empty for nulls and where it is missing."""
    at = F.instr(url, "://")
    rest = F.when(url.isNull() | (at == 0), F.lit("")).otherwise(F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), rest


def rules_for(texts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``digest``, ``rule`` and ``said`` of the texts (``digest``, ``host``, ``path``) that a rule fits.

    ``rules``: verdict and host/path, such as ("block", "net/es/").
    """
    spark = texts.sparkSession
    parts = [(r[: r.index("/")], r[r.index("/") :], r, said) for said, r in rules]
    listed = json.dumps([dict(zip(("suffix", "prefix", "rule", "said"), part, strict=True)) for part in parts])
    rows = F.inline(F.from_json(F.lit(listed), "array<struct<suffix:string,prefix:string,rule:string,said:string>>"))
    table = Table(spark.range(1).select(rows), "rules")
    # Of a host's labels only as many matter as the rule with the most has.
    deepest = max((suffix.count(".") + 1 for suffix, *_ in parts), default=1)
    labels = F.slice(F.reverse(F.split("host", r"\.")), 1, deepest)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.reverse(F.slice(labels, 1, n)), "."))
    each = texts.select("digest", "path", F.explode(suffixes).alias("suffix")).join(table.side(), "suffix").filter(F.startswith("path", F.col("prefix")))
    best = each.groupBy("digest").agg(F.max(F.struct(F.char_length("rule").alias("size"), "rule", "said")).alias("best"))
    return best.select("digest", "best.rule", "best.said")


def _grams(texts: DataFrame) -> DataFrame:
    """A row for every character of each ``text`` and its end: ``g``, the ``ORDER`` characters before it and itself, beside all columns but ``text``."""
    padded = texts.withColumn("__docloom_n", F.char_length("text")).withColumn("__docloom_t", F.split(F.concat(F.lit(_PAD * ORDER), F.translate("text", _UPPER, _LOWER), F.lit(_PAD)), ""))
    at = padded.select("*", F.explode(F.sequence(F.lit(ORDER), F.col("__docloom_n") + ORDER)).alias("__docloom_i"))
    g = F.concat(*[F.get(F.col("__docloom_t"), F.col("__docloom_i") - back) for back in range(ORDER, -1, -1)])
    return at.select(*[c for c in texts.columns if c != "text"], g.alias("g"))


def _fit(texts: DataFrame) -> Table:
    """``g`` of all distinct grams of ``text``, and ``ratio``: the log ratio of the two models, trained on rows whose ``good`` is not null, ``m`` times each."""
    rows = _grams(_spread(texts))
    good, bad = F.when(F.col("good"), F.col("m")).otherwise(0), F.when(~F.col("good"), F.col("m")).otherwise(0)
    top = Table(rows.groupBy("g").agg(F.sum(good).alias("a"), F.sum(bad).alias("b")), "grams")
    facts = top.df.agg(F.count_distinct(F.right("g", F.lit(1))).alias("symbols"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    side_a: Column = F.lit(1 / max(1, facts.symbols))
    side_b = side_a
    found, drops = top.df.select("g", F.lit(facts.a or 0).alias("na0"), F.lit(facts.b or 0).alias("nb0")), [top]
    for n in range(ORDER + 1):
        # How often each symbol follows each context of n characters, and the context occurs, in each class.
        counts = top.df.filter("a + b > 0").groupBy(F.right("g", F.lit(n + 1)).alias("k")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        grams = Table(counts, f"order{n}")
        drops.append(grams)
        found = found.withColumn(f"k{n}", F.right("g", F.lit(n + 1)))
        found = found.join(grams.side().select(F.col("k").alias(f"k{n}"), F.col("a").alias(f"a{n}"), F.col("b").alias(f"b{n}")), f"k{n}", "left")
        if n:  # the empty context has been counted
            contexts = Table(grams.df.groupBy(F.substr("k", F.lit(1), F.lit(n)).alias(f"x{n}")).agg(F.sum("a").alias(f"na{n}"), F.sum("b").alias(f"nb{n}")), f"contexts{n}")
            drops.append(contexts)
            found = found.withColumn(f"x{n}", F.substr(f"k{n}", F.lit(1), F.lit(n))).join(contexts.side(), f"x{n}", "left").drop(f"x{n}")
        found = found.drop(f"k{n}")

        def step(p: Column, side: str, n: int = n) -> Column:
            seen, total = (F.coalesce(F.col(f"{what}{n}"), F.lit(0)) for what in (side, "n" + side))
            return (seen + WEIGHT * p) / (total + WEIGHT)

        side_a, side_b = step(side_a, "a"), step(side_b, "b")
    ratio = F.round((F.log(side_a) - F.log(side_b)) * UNIT).cast("long")
    made = Table(found.select("g", ratio.alias("ratio")), "ratios")
    for table in drops:
        table.drop()
    return made


def _spread(texts: DataFrame) -> DataFrame:
    """Texts over all partitions, as each becomes a row for every character."""
    return texts.repartition(shuffle_partitions(texts.sparkSession))


def score_texts(texts: DataFrame, model: Table) -> DataFrame:
    """``digest`` (of distinct texts) and ``score``, the mean over the characters of ``text`` of the log ratio of the two models."""
    rows = _grams(_spread(texts.select("digest", "text"))).join(model.side(), "g")
    return rows.groupBy("digest").agg((F.sum("ratio") / F.count("*") / UNIT).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The threshold with the best balanced accuracy over rows of ``score``, ``good`` and ``m``; found on a bounded histogram."""
    low = -4 * BINS
    binned = scored.select(F.floor(F.least(F.greatest(F.col("score"), F.lit(-4.0)), F.lit(4.0)) * BINS).cast("int").alias("bin"), "good", "m")
    rows = binned.groupBy("bin").agg(F.sum(F.when(F.col("good"), F.col("m")).otherwise(0)).alias("a"), F.sum(F.when(F.col("good"), 0).otherwise(F.col("m"))).alias("b")).orderBy("bin").collect()
    a, b = sum(r.a for r in rows), sum(r.b for r in rows)
    if not a or not b:
        return 0.0
    best, at, below_a, below_b = -1.0, 0.0, 0, 0
    for i, r in enumerate(rows):
        value = (a - below_a) / a + below_b / b
        if value > best:
            best, at = value, ((r.bin + (rows[i - 1].bin if i else low)) / 2 + 0.5) / BINS if i else r.bin / BINS
        below_a, below_b = below_a + r.a, below_b + r.b
    return at


ADDED = ("host", "path", "rule", "verdict", "score")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null: none fits), ``verdict`` (allow or block) and ``score``."""
    host, path, rest = url_parts(F.col(url_col))
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in ADDED]
    rows = pages.select(*keep, host.alias("host"), path.alias("path"), rest.alias("__docloom_text"), F.unhex(F.sha2(rest.cast("binary"), 256)).alias("__docloom_digest"))
    with scratch():
        # Each distinct text is judged once; how often it occurs is its weight.
        text = rows.groupBy(F.col("__docloom_digest").alias("digest")).agg(F.first("__docloom_text").alias("text"), F.first("host").alias("host"), F.first("path").alias("path"), F.count("*").alias("m"))
        plain = Table(text, "plain")
        texts = Table(plain.df.join(Table(rules_for(plain.df, rules), "ruled").side(), "digest", "left").select("digest", "text", "m", "rule", "said", (F.col("said") == "allow").alias("good")), "texts")
        lettered = texts.df.filter("text != ''")
        held = F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(FOLDS)) == 0
        # The held-out fold adds its grams, but no counts.
        model = _fit(lettered.select("text", F.when(~held, F.col("good")).alias("good"), "m"))
        scores = Table(score_texts(lettered, model), "scores")
        scored = texts.df.join(scores.df, "digest", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        threshold = calibrate(scored.filter(F.col("good").isNotNull() & held & (F.col("text") != "")))
        verdict = F.coalesce("said", F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block")))
        judged = Table(scored.select(F.col("digest").alias("__docloom_digest"), "rule", verdict.alias("verdict"), "score"), "judged").keep()
    return rows.join(judged.side(), "__docloom_digest", "left").select(*keep, "host", "path", "rule", "verdict", "score")
