"""Skip-gram with negative sampling on a partitioned model.

The model is two tables, ``centre`` and ``context`` vectors by word index; nothing model-sized is on the driver or in a
broadcast.  Training examples come from D3-D5 (pairs and noise draws), equal ones as one row with their number, so a frequent pair costs
one row.  A step is synchronous:

1. scores: examples joined with both vectors; each becomes a number, rate * n * (label - sigmoid(dot)), written
   with the example's loss as a narrow table;
2. gradients: scores joined with the other side's vectors, summed per word by an aggregate with map-side
   combine (a frequent word is one row per task before the shuffle);
3. new vectors: old ones plus their gradient, written to the shared checkpoint folder, which cuts the lineage.

A word takes the step of at most ``per_word`` of its examples (its mean gradient times that), so frequent words do not overshoot;
rarer ones add up as in sequential training.  The driver sees one loss a step.  Sums are in double precision and every draw is a
stable hash, so steps repeat exactly but for the order of additions.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stable import stable_u01
from tessera.operators import corpus as C
from tessera.session import ensure_checkpoint_dir


def training_examples(pairs: DataFrame, noise: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """(centre, target, label, n): the pairs with label 1 and their noise draws with label 0, each distinct one once."""
    count = F.count(F.lit(1)).alias("n")
    seen = pairs.groupBy("centre", F.col("context").alias("target")).agg(count)
    drawn = C.negative_samples(pairs, noise, k, seed).groupBy("centre", F.col("negative").alias("target")).agg(count)
    return (seen.select("centre", "target", F.lit(1).alias("label"), "n")
            .unionByName(drawn.select("centre", "target", F.lit(0).alias("label"), "n")))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def score_examples(examples: DataFrame, centre: DataFrame, context: DataFrame, rate: float) -> DataFrame:
    """(centre, target, n, g, loss) with g the factor of the example's gradient."""
    x = (examples.join(centre.select(F.col("idx").alias("centre"), F.col("vec").alias("a")), "centre")
         .join(context.select(F.col("idx").alias("target"), F.col("vec").alias("b")), "target")
         .select("centre", "target", "label", "n", _dot("a", "b").alias("dot")))
    p = 1.0 / (1.0 + F.exp(-F.col("dot")))
    margin = F.when(F.col("label") == 1, F.col("dot")).otherwise(-F.col("dot"))
    # log(1 + e^-m) without overflow
    loss = F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
    return x.select("centre", "target", "n", (F.lit(rate) * F.col("n") * (F.col("label") - p)).alias("g"), (F.col("n") * loss).alias("loss"))


def moved(vectors: DataFrame, other: DataFrame, scores: DataFrame, own: str, by: str, per_word: float) -> DataFrame:
    """``vectors`` after a step: plus the sum of g times the other side's vectors."""
    grad = array_to_vector(F.transform("o", lambda v: v * F.col("g")))
    sums = (scores.join(other.select(F.col("idx").alias(by), F.col("vec").alias("o")), by).groupBy(F.col(own).alias("idx"))
            .agg(vector_to_array(Summarizer.sum(grad)).alias("s"), F.sum("n").alias("n")))
    scale = F.greatest(F.lit(1.0), F.col("n") / F.lit(float(per_word)))
    new = F.when(F.col("s").isNull(), F.col("vec")).otherwise(F.zip_with("vec", "s", lambda v, s: v + s / scale))
    return vectors.join(sums, "idx", "left").select("idx", new.alias("vec"))


class PartitionedModel:
    """Vectors as tables, and the mean loss before every step."""

    def __init__(self, vocab: DataFrame, centre: DataFrame, context: DataFrame, losses: list[float]):
        self.vocab, self.centre, self.context, self.losses = vocab, centre, context, losses

    def embedding_table(self) -> DataFrame:
        """(word, vector array<double>)."""
        return self.centre.join(self.vocab.select("idx", "word"), "idx").select("word", F.col("vec").alias("vector"))


def fit_partitioned(examples: DataFrame, vocab: DataFrame, dim: int = 100, steps: int = 10, rate: float = 0.025, per_word: float = 100.0,
                    seed: int = 42) -> PartitionedModel:
    """Trains vectors of ``vocab`` (word, idx) on ``examples`` (centre, target, label, n) for ``steps`` synchronous steps.

    Words without examples keep their first vectors.  Empty examples or vocabularies give a model without losses.
    """
    if dim < 1 or steps < 1 or rate <= 0 or per_word <= 0:
        raise ValueError("dim and steps must be >= 1, rate and per_word > 0")
    spark = vocab.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/sgns-{uuid4().hex}"

    def write(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    examples = write("examples", examples.select("centre", "target", "label", "n"))
    places = F.sequence(F.lit(0), F.lit(dim - 1))
    u = F.transform(places, lambda d: (stable_u01("idx", seed, d) - 0.5) / dim)
    centre = write("centre0", vocab.select("idx", u.alias("vec")))
    context = write("context0", vocab.select("idx", F.transform(places, lambda d: F.lit(0.0)).alias("vec")))
    losses = []
    for step in range(1, steps + 1):
        scores = write(f"scores{step}", score_examples(examples, centre, context, rate))
        loss, n = scores.agg(F.sum("loss"), F.sum("n")).first()
        if not n:
            break
        losses.append(loss / n)
        now = centre, context
        centre = write(f"centre{step}", moved(now[0], now[1], scores, "centre", "target", per_word))
        context = write(f"context{step}", moved(now[1], now[0], scores, "target", "centre", per_word))
    return PartitionedModel(vocab, centre, context, losses)
