"""Quality rules of a text and of its lines' frequency across documents, DataFrame only.

Base rules look at one text: its words, symbols, repeated lines and repeated runs of three
words. The method's rule looks across documents: normalised lines (lower-cased, white space
runs as one space, trimmed) are hashed, the distinct texts of a host that hold a line are
counted, lines above the limits go, and a document left with too few of its words is
rejected. A line is common if at least `min_docs` texts of its host hold it and these are
more than `max_share` of the host's distinct texts: shares, so that the rule means the same
on a small and on a large host. Copies of a whole text count once, as removing those is the
task of exact deduplication.

No text is shuffled: lines travel as hashes, counted per task before they meet. Common lines
are met under several salts, so that a line of a third of all documents is no hot key.
Within a text, windows of three words are sorted by their 64-bit hash.

Defined results: a null text has no words and fails the base rules, as every text of under 50
words does; rows of a null host belong to one host of their own; repeated rows and null or
repeated ids each keep their row; an empty table gives an empty one; other columns, whatever
their names, are not read; texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, free_name, stored, with_row_key

SPACE = "[\\x20\\x09-\\x0D]+"
VISIBLE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A line is common in a host if so many of its texts, and more than this share, hold it.
MIN_DOCS, MAX_SHARE = 20, 0.05
#: The least share of its words that a document must keep.
LEAST_LEFT = 0.5
#: Partners of a common line, so that the rows of a hot one spread.
SALTS = 32
WINDOW = 3


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def normalised(line: Column) -> Column:
    """A line as it is compared across documents."""
    return F.trim(F.lower(F.regexp_replace(line, SPACE, " ")))


def _repeated_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words: words under some window of three that the text has twice or more."""
    last = F.size("words") - WINDOW

    def window(i: Column) -> Column:
        parts = [F.get("words", i + k) for k in range(WINDOW)]
        return F.struct(F.xxhash64(*parts).alias("h"), i.alias("at"))

    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    windows = F.sort_array(F.transform(F.coalesce(starts, F.array().cast("array<int>")), window))

    def beside(x: Column, i: Column) -> Column:
        same = [F.get("windows", i + k)["h"] == x["h"] for k in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    twice = F.sort_array(F.transform(F.filter("windows", beside), lambda x: x["at"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def cover(held: Column, at: Column) -> Column:
        end = at + WINDOW
        return F.struct(
            (held["n"] + end - F.greatest(at, held["end"])).alias("n"), end.alias("end")
        )

    covered = F.aggregate(twice, start, cover)["n"].cast("long")
    return df.withColumn("windows", windows).withColumn("n_repeat_words", covered).drop("windows")


def measures(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Per row, stored: doc_id, row key, host, content, base measures, lines as (h, words)."""
    keyed = with_row_key(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            # No host is written as no text, every other one after a sign.
            F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("host"),
        )
    )
    told = keyed.withColumn("words", _words(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(VISIBLE))
    )

    def hashed(line: Column) -> Column:
        return F.transform(
            F.array(normalised(line)),
            lambda x: F.struct(F.xxhash64(x).alias("h"), F.size(F.split(x, " ")).alias("words")),
        )[0]

    measured = _repeated_words(told).select(
        "doc_id",
        FILE,
        ROW,
        "host",
        F.xxhash64("text").alias("content"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform("lines", hashed).alias("lines"),
    )
    return stored(measured, "line-measures")


def common_lines(
    measured: DataFrame, *, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE
) -> DataFrame:
    """Lines above the limits, stored: host, h, in_texts, of_texts."""
    lines = measured.select("host", "content", F.explode(F.array_distinct("lines.h")).alias("h"))
    held = lines.distinct().groupBy("host", "h").agg(F.count("*").alias("in_texts"))
    hosts = (
        measured.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("of_texts"))
    )
    frequent = held.where(F.col("in_texts") >= min_docs).join(hosts, "host")
    return stored(frequent.where(F.col("in_texts") > F.col("of_texts") * max_share), "common-lines")


def line_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = MIN_WORDS,
    max_repeat_pct: int = MAX_REPEAT_PCT,
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """Per row: doc_id, row key, measures, lost_words, common (hashes that go), base_failed, kept."""
    measured = measures(docs, id_col=id_col, text_col=text_col, host_col=host_col)
    common = common_lines(measured, min_docs=min_docs, max_share=max_share)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    partners = common.select("host", "h", salts.alias("salt"))
    lines = measured.select(
        FILE, ROW, "host", F.pmod(ROW, F.lit(SALTS)).cast("int").alias("salt"), F.explode("lines").alias("line")
    ).select(FILE, ROW, "host", "salt", "line.h", "line.words")
    # Per document at most its own lines.
    lost = (
        lines.join(partners, ["host", "h", "salt"])
        .groupBy(FILE, ROW)
        .agg(F.sum("words").alias("lost_words"), F.collect_set("h").alias("common"))
    )
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")
    )
    left = F.col("n_words") - F.col("lost_words")
    return (
        measured.drop("lines", "content")
        .join(lost, [FILE, ROW], "left")
        .withColumn("lost_words", F.coalesce("lost_words", F.lit(0)).cast("long"))
        .withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * least_left))
    )


def without_common_lines(
    docs: DataFrame, rules: DataFrame, *, text_col: str = "text"
) -> DataFrame:
    """The documents that line_rules(docs) keeps, with all their columns, less common lines."""
    file, row, gone = (free_name(docs, n) for n in (FILE, ROW, "__gone"))
    kept = rules.where("kept").select(
        F.col(FILE).alias(file), F.col(ROW).alias(row), F.col("common").alias(gone)
    )
    joined = with_row_key(docs, file, row).join(kept.hint("shuffle_hash"), [file, row])
    lines = F.filter(
        F.split(F.col(text_col), "\n"),
        lambda x: ~(x.rlike(VISIBLE) & F.array_contains(F.col(gone), F.xxhash64(normalised(x)))),
    )
    text = F.when(F.size(gone) == 0, F.col(text_col)).otherwise(F.array_join(lines, "\n"))
    return joined.withColumn(text_col, text).select(*docs.columns)


SQL = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host
  FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t
), g AS (
  SELECT r, k, words[k] AS a, words[k + 1] AS b, words[k + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS k FROM w)
), twice AS (
  SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest([k, k + 1, k + 2]) AS pos FROM twice) GROUP BY r
), lines AS (
  SELECT r, host, text, line,
    trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS norm
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), hosts AS (
  SELECT host, count(DISTINCT text) AS n FROM t GROUP BY host
), common AS (
  SELECT host, norm FROM (
    SELECT host, norm, count(DISTINCT text) AS n FROM lines GROUP BY host, norm
  ) held JOIN hosts USING (host)
  WHERE held.n >= {MIN_DOCS} AND held.n > hosts.n * {MAX_SHARE}
), lost AS (
  SELECT r, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS n
  FROM lines JOIN common USING (host, norm) GROUP BY r
), base AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.n, 0) AS lost
  FROM t JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
    AND n_words - lost >= n_words * {LEAST_LEFT} AS kept
FROM base
"""
