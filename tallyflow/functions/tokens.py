"""Splitting search text into words, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed pattern: a run of Han characters, or a run of other letters and digits.
RUNS = r"(\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+)"


def words(text: Column | str) -> Column:
    """Lower-cased words; a Han run gives its overlapping character pairs."""
    col = F.lower(F.col(text) if isinstance(text, str) else text)
    runs = F.regexp_extract_all(col, F.lit(RUNS), F.lit(1))

    def pieces(run: Column) -> Column:
        size = F.length(run)
        pairs = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.substr(run, i, F.lit(2)))
        return F.when(run.rlike(r"^\p{IsHan}{2}"), pairs).otherwise(F.array(run))

    return F.flatten(F.transform(runs, pieces))


def split_words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per word; the other columns are repeated."""
    return df.withColumn(word, F.explode(words(text)))


def _spans(runs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """`_id`, `word` of all lexicon words in the runs (`_id`, `_part`), and of the characters that none covers."""
    known = lexicon.select(F.lower(F.col("word")).alias("word")).where(F.length("word") > 0).distinct()
    longest = known.agg(F.max(F.length("word"))).first()[0] or 1
    # A start carries only as much text as a word can have, not its whole run.
    heads = F.transform(
        F.sequence(F.lit(1), F.length("_part")),
        lambda i: F.struct(i.alias("at"), F.substr("_part", i, F.lit(longest)).alias("head")),
    )
    starts = runs.select("_id", F.explode(heads).alias("s")).select("_id", "s.at", "s.head")
    # The first two characters tell which lengths can be a word at all; a prefix has few lengths, however many words.
    prefixes = known.groupBy(F.substring("word", 1, 2).alias("prefix")).agg(F.collect_set(F.length("word")).alias("lengths"))
    one, two = F.substring("head", 1, 1), F.substring("head", 1, 2)
    opened = starts.withColumn("prefix", F.explode(F.when(F.length("head") > 1, F.array(one, two)).otherwise(F.array(one))))
    fitting = F.filter("lengths", lambda n: n <= F.length("head"))
    tried = opened.join(prefixes, "prefix").select("_id", "at", "head", F.explode(fitting).alias("len"))
    found = tried.select("_id", "at", F.substr("head", F.lit(1), F.col("len")).alias("word")).join(known, "word")
    covered = found.select("_id", F.explode(F.sequence(F.col("at"), F.col("at") + F.length("word") - 1)).alias("at"))
    # Places are exploded from runs; Spark sizes them like the runs and would broadcast them.
    alone = starts.join(covered.distinct().hint("merge"), ["_id", "at"], "left_anti").select("_id", one.alias("word"))
    return found.select("_id", "word").unionByName(alone)


def dictionary_words(df: DataFrame, text: str, lexicon: DataFrame, word: str = "word", script: str = r"\p{IsHan}") -> DataFrame:
    """Fine-grained segmentation: one row per lexicon word at each place of the text; other columns are repeated.

    Runs that open with a character of `script` are cut by the `lexicon(word)`
    table: all its words come out wherever they stand, overlapping ones too, and
    characters that no word covers come out alone.  Other runs of letters and
    digits pass whole.  Equal runs are cut once, however often they stand in
    texts.  Null and empty texts give no rows; an empty lexicon cuts runs into
    characters.
    """
    runs = F.regexp_extract_all(F.lower(F.col(text)), F.lit(RUNS), F.lit(1))
    parts = df.select("*", F.explode(runs).alias("_part"))
    cut = F.col("_part").rlike(f"^{script}")
    out = [*df.columns, word]
    plain = parts.where(~cut).withColumn(word, F.col("_part"))
    keyed = parts.where(cut).withColumn("_id", F.sha2("_part", 256))
    spans = _spans(keyed.select("_id", "_part").distinct(), lexicon).withColumnRenamed("word", word)
    # So it would with runs that were cut out of texts and carry long keys.
    return plain.select(*out).unionByName(keyed.drop("_part").hint("merge").join(spans, "_id").select(*out))
