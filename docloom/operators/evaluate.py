"""Model evaluation: accuracy, weighted precision and recall, class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.sources.io import shared_folder


def accuracy(rows: DataFrame, truth: str, predicted: str, by: str | None = None) -> DataFrame:
    out = rows.groupBy(*([by] if by else [])).agg(F.count("*").alias("n"), F.sum(F.when(F.col(truth) == F.col(predicted), 1).otherwise(0)).alias("correct"))
    return out.withColumn("accuracy", F.col("correct") * 100.0 / F.col("n"))


def weighted_scores(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 weighted by support, and accuracy, in one row; 0 where a ratio has no denominator."""
    cells = rows.groupBy(F.col(truth).cast("string").alias("t"), F.col(predicted).cast("string").alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select(F.col("t").alias("label"), F.col("n").alias("support"), F.lit(0).alias("guessed"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit")).union(cells.select("p", F.lit(0), "n", F.lit(0)))
    each = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    p, r = (F.when(F.col(c) > 0, F.col("hit") / F.col(c)).otherwise(0.0) for c in ("guessed", "support"))
    each = each.withColumns({"p": p, "r": r}).withColumn("f", F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0))
    total = F.sum("support")
    return each.agg(*[(F.sum(F.col(c) * F.col("support")) / total).alias(n) for c, n in (("p", "precision"), ("r", "recall"), ("f", "f1"))], (F.sum("hit") / total).alias("accuracy"))


def class_weights(tags: DataFrame, labels: list[str], tag: str = "tag") -> DataFrame:
    """Total over classes times count (1 if none), held to 0.5 .. 10, half as much again for B- tags."""
    spark = tags.sparkSession
    known = spark.createDataFrame([(x,) for x in labels], "label string")
    counts = tags.groupBy(F.col(tag).alias("label")).agg(F.count("*").alias("n"))
    every = known.join(counts, "label", "full").withColumn("total", F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy()))
    raw = F.col("total") / (F.lit(len(labels)) * F.coalesce("n", F.lit(1)))
    held = F.least(F.greatest(raw, F.lit(0.5)), F.lit(10.0))
    return every.join(F.broadcast(known), "label", "left_semi").select("label", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.startswith("label", F.lit("B-")), held * 1.5).otherwise(held).alias("weight"))


def in_training(key: str, percent: int = 80, seed: int = 42) -> Column:
    """A stable split by a hash of a seed and a key; another seed deals anew, and no row depends on the others."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), 1, 4) < F.lit(f"{65536 * percent // 100:04x}")


_DIGITS, _WIDTH = 15, 3


def split_exactly(rows: DataFrame, key: str, percent: int = 80, seed: int = 42) -> DataFrame:
    """``training``: true for exactly ``percent`` of a hundred of the distinct keys, rounded down: those whose hash of seed and key is smallest.

    Rows follow their key, and a null key is one.  The last hash that is in is found digit by digit: each pass counts keys by the next digits
    of those that agree so far, a few thousand counts for the driver, and nothing is sorted or ranked.  Keys of one hash go in order of the key.
    """
    spark = rows.sparkSession
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    code = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary")), 1, _DIGITS)
    path = shared_folder(spark)
    rows.select(F.col(key).alias("key")).distinct().select("key", F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary")), 1, _DIGITS).alias("code")).write.parquet(path)
    keys = spark.read.parquet(path)
    left, prefix = keys.count() * percent // 100, ""
    if not left:
        return rows.withColumn("training", F.lit(False))
    while len(prefix) < _DIGITS:
        upto = F.substring("code", 1, len(prefix) + _WIDTH)
        for r in sorted(keys.filter(F.startswith("code", F.lit(prefix))).groupBy(upto.alias("p")).agg(F.count("*").alias("n")).collect()):
            if left <= r.n:
                prefix = r.p
                break
            left -= r.n
    # ``left`` of the keys whose hash is the prefix are in: all of them, unless hashes are equal.
    last = keys.filter(F.col("code") == prefix).orderBy(F.col("key").asc_nulls_first()).limit(left).collect()
    named = [r.key for r in last if r.key is not None]
    chosen = F.col(key).isin(named) if named else F.lit(False)
    if len(named) < len(last):
        chosen = F.coalesce(chosen, F.lit(False)) | F.col(key).isNull()
    return rows.withColumn("training", (code < prefix) | ((code == prefix) & F.coalesce(chosen, F.lit(False))))


def compared(rows: DataFrame, truth: str, models: dict[str, tuple[str, str]], baseline: str, case_type: str) -> DataFrame:
    """``model, case_type, n, correct, accuracy, difference, mean_confidence`` of models (name: columns of prediction and confidence), for each case type and
    for all cases (a null ``case_type``): accuracy in percent, how far it is from the baseline's, and the mean confidence where a model is right (null if never)."""
    each = [F.struct(F.lit(name).alias("model"), F.coalesce(F.col(p).eqNullSafe(F.col(truth)), F.lit(False)).alias("right"), F.col(c).cast("double").alias("confidence")) for name, (p, c) in models.items()]
    long_ = rows.select(F.col(case_type).cast("string").alias("case_type"), F.inline(F.array(*each)))
    right = F.col("right")
    cells = long_.groupBy("model", "case_type").agg(F.count("*").alias("n"), F.count_if(right).alias("correct"), F.sum(F.when(right, F.col("confidence").cast("decimal(28, 12)"))).alias("sure"))
    every = cells.groupBy("model").agg(F.lit(None).cast("string").alias("case_type"), F.sum("n").alias("n"), F.sum("correct").alias("correct"), F.sum("sure").alias("sure"))
    both = cells.unionByName(every).withColumn("accuracy", F.col("correct") * 100.0 / F.col("n"))
    other = both.filter(F.col("model") == baseline).select(F.col("case_type").alias("__case"), F.col("accuracy").alias("__base"))
    out = both.join(F.broadcast(other), F.col("case_type").eqNullSafe(F.col("__case")))  # a row for each case type
    return out.select("model", "case_type", "n", "correct", "accuracy", (F.col("accuracy") - F.col("__base")).alias("difference"), F.when(F.col("correct") > 0, F.col("sure").cast("double") / F.col("correct")).alias("mean_confidence"))


def label_maps(labels: list[str]) -> tuple[dict[str, int], dict[int, str]]:
    """Numbers of labels, in their order, and back."""
    numbers = {label: i for i, label in enumerate(labels)}
    return numbers, {i: label for label, i in numbers.items()}


def numbered_labels(rows: DataFrame, label: str) -> DataFrame:
    """``label, id``: the distinct labels of a table, numbered from 0 in their order; a null is no label.  Labels are few, rows are not."""
    found = rows.filter(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    return found.select("label", (F.row_number().over(Window.partitionBy().orderBy("label")) - 1).alias("id"))


def aligned(word_numbers: Column, tags: Column, labels: list[str], ignored: int = -100) -> Column:
    """A label's number for each sub-token: at the first one of a word its tag's, at others and at special ones (null) ``ignored``.

    ``word_numbers``: for each sub-token the word it is of; ``tags``: a tag for each word.
    """
    numbers = F.create_map(*[F.lit(x) for pair in label_maps(labels)[0].items() for x in pair])

    def number(w: Column, i: Column) -> Column:
        first = w.isNotNull() & ((i == 0) | ~w.eqNullSafe(F.get(word_numbers, i - 1)))
        return F.when(first, F.coalesce(F.try_element_at(numbers, F.get(tags, w)), F.lit(ignored))).otherwise(ignored)

    return F.transform(word_numbers, number)


def softmax_best(logits: Column) -> Column:
    """``label`` (index of the largest, the first among equals) and ``score``, its share under softmax."""
    top = F.array_max(logits)
    return F.struct((F.array_position(logits, top) - 1).cast("int").alias("label"), (F.lit(1.0) / F.aggregate(logits, F.lit(0.0), lambda t, x: t + F.exp(x - top))).alias("score"))
