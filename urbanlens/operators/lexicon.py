"""A small hand-written English opinion lexicon, so that the sentiment job can be run without a file.

Valences are this library's own, from -4 (worst) to 4 (best); a published lexicon file goes through ``read_lexicon`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: words by valence ------------------------------------------
WORDS = {
    3.0: "amazing awesome brilliant excellent fantastic gorgeous love loved outstanding perfect superb wonderful",
    2.5: "best delightful enjoyed glad great happy joy lovely proud thrilled",
    2.0: "beautiful better charming enjoy excited fun good impressive nice pleasant safe smart thanks welcome win",
    1.5: "calm clean comfortable easy fair friendly helpful hope interesting like quick quiet recommend useful",
    -1.0: "busy crowded late noisy odd slow",
    -1.5: "annoying bored boring cold cost delay delayed dirty lost noise problem sad tired wait weak wrong",
    -2.0: "angry bad broken closed complaint disappointed expensive fail failed hurt pain poor rude stuck ugly unhappy unsafe worry",
    -2.5: "afraid awful crime disaster fear filthy hate hated nasty stolen terrible theft ugliest worse",
    -3.0: "assault dead death disgusting dreadful horrible killed murder terror worst",
}
# ----------------------------------------------------------------------------


def default_lexicon(spark: SparkSession) -> DataFrame:
    """``(token, valence)`` of the built-in words."""
    return spark.createDataFrame([(w, v) for v, words in WORDS.items() for w in words.split()], "token string, valence double")
