"""Quality rules: counts over one document, and line frequency across the documents of a host.

The first part counts words, symbols, repeated lines and repeated three-word windows inside each text. The second hashes
normalised lines, counts in how many distinct documents of a host each occurs, removes lines above the limits and rejects
documents of which too little is left. Distinct documents are distinct texts, so copies of one document do not make its
own lines boilerplate.

The per-document part is one expression over a row. The line counts are hash aggregates that add up before they shuffle;
the lines meet their counts in an equality join whose large keys Spark splits, and no text is shuffled for the verdict.

Cases: a NULL text counts as empty (no words, hence failed and not kept); a NULL host counts as the host ''; rows that
repeat an id, a text and a host are one document and get equal rows; rows with one id and different texts are different
documents; NULL ids are kept; an empty table gives an empty result; extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, and the characters counted as symbols.
SPACES = r"[\x20\x09-\x0D]+"
WORDLIKE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

LEAST_DOCUMENTS = 20  # a line in fewer distinct documents of its host always stays
MOST_SHARE_PERCENT = 2  # a line in more of the host's distinct documents goes
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Sorting the hash of every three-word window, with its place in the low bits, brings equal windows together.
_WINDOWS = ("CASE WHEN n_words < 3 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, int(n_words) - 3),"
            " i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))) END")
_PACKED = "sort_array(transform(windows, (h, i) -> shiftleft(h, bits) | bigint(i)))"
_SAME = ("(shiftright(get(packed, {a}), bits) = shiftright(get(packed, {b}), bits)"
         " AND get(windows, int(get(packed, {a}) & mask)) = get(windows, int(get(packed, {b}) & mask)))")
_REPEATED = ("CASE WHEN size(packed) < 2 THEN CAST(array() AS array<bigint>) ELSE sort_array(transform(filter("
             f"sequence(0, size(packed) - 1), j -> (j > 0 AND {_SAME.format(a='j', b='j - 1')})"
             f" OR (j < size(packed) - 1 AND {_SAME.format(a='j', b='j + 1')})), j -> get(packed, j) & mask)) END")
_COVERED = ("aggregate(repeated, struct(0L AS n, -3L AS last),"
            " (acc, p) -> struct(acc.n + least(3L, p - acc.last) AS n, p AS last), acc -> acc.n)")


def base_counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint) and base_failed to ``id, text, ...``."""
    kept = docs.columns
    out = docs.withColumns({
        "w": F.array_remove(F.split("text", SPACES), ""),
        "with_words": F.filter(F.split("text", "\n"), lambda s: s.rlike(WORDLIKE)),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint")})
    out = out.withColumns({
        "n_words": F.size("w").cast("bigint"), "word_chars": F.length(F.concat_ws("", "w")).cast("bigint"),
        "n_dup_lines": (F.size("with_words") - F.size(F.array_distinct("with_words"))).cast("bigint")})
    out = out.withColumns({"windows": F.expr(_WINDOWS), "bits": F.length(F.bin("n_words"))})
    out = out.withColumn("mask", F.expr("shiftleft(1L, bits) - 1")).withColumn("packed", F.expr(_PACKED))
    out = out.withColumn("repeated", F.expr(_REPEATED)).withColumn("n_repeat_words", F.expr(_COVERED))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return out.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def normal_lines(text: Column) -> Column:
    """Lines with a word, in lower case and with single spaces: array of (pos, line hash, words)."""
    flat = F.regexp_replace(F.lower(text), r"[ \t\x0B\f\r]+", " ")
    lines = F.transform(F.split(flat, "\n"), lambda s, i: F.struct(i.alias("pos"), F.trim(s).alias("s")))
    return F.transform(F.filter(lines, lambda x: x["s"] != ""), lambda x: F.struct(
        x["pos"].alias("pos"), F.xxhash64(x["s"]).alias("line"), F.size(F.split(x["s"], " ")).cast("bigint").alias("words")))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  least_documents: int = LEAST_DOCUMENTS, most_share_percent: int = MOST_SHARE_PERCENT) -> DataFrame:
    """One row per input row: the id, the base counts, removed_words, kept and cleaned_text, the text without lines that go.

    A line goes when at least ``least_documents`` distinct documents of its host hold it and these are more than
    ``most_share_percent`` of all of them. A document is kept if the base rules pass and more than half its words are left.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                     F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"))
    docs = docs.withColumn("print", F.xxhash64("text"))
    lines = docs.select("id", "print", "host", normal_lines(F.col("text")).alias("lines"))
    of_host = docs.groupBy("host").agg(F.count_distinct("print").alias("of_host"))
    held = lines.select("host", "print", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    counted = held.groupBy("host", "line").agg(F.count_distinct("print").alias("n")).where(F.col("n") >= least_documents)
    frequent = (counted.join(of_host, "host").where(100 * F.col("n") > most_share_percent * F.col("of_host"))
                .select(F.col("host").alias("f_host"), F.col("line").alias("f_line")))
    occurring = lines.select("id", "print", "host", F.inline("lines"))
    gone = (occurring.join(frequent, (F.col("host") == F.col("f_host")) & (F.col("line") == F.col("f_line")))
            .groupBy(F.col("id").alias("g_id"), F.col("print").alias("g_print"), F.col("host").alias("g_host"))
            .agg(F.collect_set(F.struct("pos", "words")).alias("gone")))
    out = base_counts(docs).join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("print") == F.col("g_print"))
                                 & (F.col("host") == F.col("g_host")), "left")
    out = out.withColumn("removed_words", F.coalesce(
        F.aggregate("gone", F.lit(0).cast("bigint"), lambda acc, x: acc + x["words"]), F.lit(0).cast("bigint")))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda s, i: ~F.array_contains(F.col("gone.pos"), i)), "\n")
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "removed_words", (~F.col("base_failed") & (2 * F.col("removed_words") < F.col("n_words"))).alias("kept"),
                      F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("cleaned_text"))


SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
split AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
triples AS (SELECT doc_id, pos, word, lead(word, 1) OVER o AS second, lead(word, 2) OVER o AS third FROM words
    WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
often AS (SELECT doc_id, pos FROM triples WHERE third IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY doc_id, word, second, third) > 1),
covered AS (SELECT doc_id, count(DISTINCT pos + step) AS n FROM often, (VALUES (0), (1), (2)) s(step) GROUP BY doc_id),
lines AS (SELECT doc_id, text, host, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '[ \t\x0B\f\r]+', ' ', 'g')) AS line FROM docs),
frequent AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS n FROM lines WHERE line <> '' GROUP BY host, line)
    JOIN (SELECT host, count(DISTINCT text) AS all_of FROM docs GROUP BY host) USING (host) WHERE n >= 20 AND 100 * n > 2 * all_of),
gone AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS n FROM lines JOIN frequent USING (host, line) GROUP BY doc_id),
counts AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0)::BIGINT AS removed_words
    FROM split LEFT JOIN covered c USING (doc_id) LEFT JOIN gone g USING (doc_id))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed_words < n_words AS kept FROM counts
"""
