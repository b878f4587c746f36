"""What the third round's findings named: plans of the corpus operators that would fill the driver."""

import numpy as np

from ledgerforge.llm import hard_negatives as H
from ledgerforge.llm import topk as T


def exchanged(df):
    """The data that a plan broadcasts: the schema lines of its broadcast exchanges' children."""
    df.collect()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in line]


def test_blocks_and_packs_are_never_broadcast(spark):
    """Blocks and packs are small on disk, and a pack stands once for each block: a broadcast would bring them to the driver whole."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], int(i % 3)) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert not exchanged(T.top_k(vectors))
    assert not [line for line in exchanged(H.hard_negatives(vectors)) if "block" in line]
