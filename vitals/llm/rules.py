"""Quality rules as a ledger of failure bits, with DataFrame expressions only.

Every rule is evaluated once for each text. The ledger keeps the measurements and
one integer whose bits say which rules failed. Policies are versioned sets of rules:
applying one is a bitwise AND, and an ablation (what a policy would keep without a
rule) is computed from counts by bit pattern, without reading a text again.

Words are runs of characters other than the six ASCII white-space characters. A word
counts as repeated if it lies in a window of five words that the text has twice or
more. Windows are compared by 64-bit hashes; where a text has equal ones, hash and
place are packed into one integer and sorted as primitive numbers, in which the hash
keeps all bits that the place leaves (44 for a million words). Windows that this makes
neighbours are compared word by word; where any differ, the windows found are sorted
and compared by their words instead.

Everything is computed inside a row, so nothing is shuffled and no key can be hot;
the work grows with a text's length times its logarithm.

Defined results: a null or empty text has no words and fails ``few_words``; other
columns are kept, the ledger's own are added under the names given; repeated rows
give repeated results; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import fresh, table

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
WINDOW = 5

# Rules in the order of their bits: name, and whether a row of measurements fails.
# Each compares integers, so that SQL gives the same answer.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "shouting": "2 * n_upper > n_letters",
    "exclamations": "10 * n_exclamations > 3 * n_words",
    "few_letters": "2 * n_letters < word_chars",
    "no_sentence": "n_words >= 50 AND n_stops = 0",
}
BASE_RULES = ("few_words", "repeated_words")
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": BASE_RULES,
    "web-1": (*BASE_RULES, "short_words", "long_words", "symbols", "duplicate_lines"),
    "web-2": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_exclamations", "n_stops")


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _left(text: Column, dropped: str) -> Column:
    """The number of characters that are not in the pattern ``dropped``."""
    return F.char_length(F.regexp_replace(text, dropped, "")).cast("bigint")


def ledger(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), the measurements and ``fail_bits``."""
    kept = df.columns if keep is None else keep
    clash = {c.lower() for c in kept} & {*MEASURES, "fail_bits"}
    if clash:
        raise ValueError(f"columns would clash: {sorted(clash)}")
    text, words, hashes, packed, places = (fresh(df, x) for x in ("text_", "words_", "hashes_", "packed_", "places_"))
    lines, bits, hits, clashed = (fresh(df, x) for x in ("lines_", "place_bits_", "hits_", "clashed_"))

    step = df.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias(text))
    trimmed = F.btrim(text, F.lit(SPACES))
    step = step.withColumn(words, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)))
    n = F.size(words)
    window = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(WINDOW)))
    )
    step = step.withColumns(
        {
            hashes: F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>")),
            lines: F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
            bits: F.length(F.bin(n.cast("bigint"))),
        }
    )
    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(bits)) - 1  # ones where the place goes
    pack = F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint")))
    step = step.withColumn(
        packed,
        F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pack)).otherwise(F.array().cast("array<bigint>")),
    )

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(F.bitwise_not(low)) == 0, F.lit(False))

    def at(x: Column) -> Column:
        return x.bitwiseAND(low)

    def differ(a: Column, b: Column) -> Column:
        unlike = F.lit(False)
        for k in range(WINDOW):
            unlike = unlike | (F.get(F.col(words), (at(a) + k).cast("int")) != F.get(F.col(words), (at(b) + k).cast("int")))
        return F.when(same(a, b), unlike).otherwise(False)

    again = F.filter(packed, lambda x, i: same(F.get(packed, i - 1), x) | same(F.get(packed, i + 1), x))
    step = step.withColumns(
        {hits: F.transform(again, at), clashed: F.size(F.filter(packed, lambda x, i: differ(F.get(packed, i - 1), x))) > 0}
    )
    spelled = F.sort_array(
        F.transform(hits, lambda p: F.struct(F.slice(F.col(words), (p + 1).cast("int"), WINDOW).alias("w"), p.alias("p")))
    )

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce(a["w"] == b["w"], F.lit(False))

    # the sorted array is bound once for the row, not made again for each of its elements
    exact = F.flatten(
        F.transform(
            F.array(spelled),
            lambda s: F.transform(
                F.filter(s, lambda x, i: equal(F.get(s, i - 1), x) | equal(F.get(s, i + 1), x)), lambda x: x["p"]
            ),
        )
    )
    step = step.withColumn(places, F.sort_array(F.when(F.col(clashed), exact).otherwise(F.col(hits))))
    covered = F.transform(places, lambda p, i: F.least(F.lit(WINDOW).cast("bigint"), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW).cast("bigint"))))
    measured = step.select(
        *kept,
        n.cast("bigint").alias("n_words"),
        _left(F.col(text), SPACE).alias("word_chars"),
        _left(F.col(text), r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_repeat_words"),
        F.size(lines).cast("bigint").alias("n_lines"),
        _left(F.col(text), r"[^A-Z]+").alias("n_upper"),
        _left(F.col(text), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+").alias("n_letters"),
        _left(F.col(text), r"[^!]+").alias("n_exclamations"),
        _left(F.col(text), r"[^.!?]+").alias("n_stops"),
    )
    fail = F.lit(0).cast("bigint")
    for number, rule in enumerate(RULES.values()):
        fail = fail + F.when(F.expr(rule), F.lit(1 << number)).otherwise(0)
    return measured.withColumn("fail_bits", fail)


def passes(policy: str) -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: rows that fail it, that only it drops, and that the
    policy would keep without it. Reads the counts by pattern, at most 2 ** rules rows."""
    bits = mask(POLICIES[policy])
    counts = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(bits)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    rule = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("bigint").alias("bit")) for r in POLICIES[policy])))
    each = counts.select("bits", "n", rule.alias("r")).select("bits", "n", "r.rule", "r.bit")
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0)("failed"),
        count(F.col("bits") == F.col("bit"))("only_this"),
        count(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0)("kept_without"),
    )


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", *MEASURES[:5], (~passes("base-1")).alias("base_failed"), passes("web-2").alias("kept"), "fail_bits"
    )


_SPACE_SQL = "'[\\x20\\x09-\\x0D]+'"
OP9_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT row_id, doc_id, text, list_filter(regexp_split_to_array(text, {_SPACE_SQL}), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, {_SPACE_SQL}, '', 'g') <> '') AS lines
  FROM texts
), windows AS (
  SELECT row_id, i, list_slice(words, i, i + {WINDOW - 1}) AS w
  FROM split, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS g(i)
), repeated AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n FROM repeated, generate_series(0, {WINDOW - 1}) AS g(k) GROUP BY row_id
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, length(regexp_replace(text, {_SPACE_SQL}, '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclamations,
         length(regexp_replace(text, '[^.!?]+', '', 'g')) AS n_stops
  FROM split LEFT JOIN covered USING (row_id)
), judged AS (
  SELECT *, {" + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))} AS bits FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & {mask(BASE_RULES)}) <> 0 AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits
FROM judged
"""
