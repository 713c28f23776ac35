"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of
one role become one block; the pieces are concatenated. The template is

    <|turn|>ROLE\\n TEXT [<|and|>TEXT ...] <|end|>\\n        (without the blanks)

``<|and|>`` stands between the texts that a block has merged, so every turn can be
read back. Control strings inside texts and roles are escaped by a backslash after
their first character, and a backslash by a second one; in a role a line break gets a
backslash too. Reading back drops each backslash and keeps what follows it.

The loss mask is run-length coded: for each turn the numbers of characters before,
under and after the mask. The text of a turn whose role is trained is under it.

One conversation is one output row, so its turns meet in one task by definition;
they are combined map-side, and every expression is linear in their number.

Defined results: null texts and roles are empty; turns go by number (null first),
equal numbers by role, then text; repeated rows are repeated turns; rows with a null
id make one conversation with a null id; an empty table gives an empty result. Only
the four columns named are read, so others of any name do no harm.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import table

# The template's marks, and control strings that texts must not forge
TURN, AND, END = "<|turn|>", "<|and|>", "<|end|>\n"
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
TRAINED = ("assistant",)
PROBE_ID = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """``id``, ``formatted`` and ``mask`` (array of structs before, under, after) of every conversation."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    sorted_turns = turns.select(F.col(id_col).alias("id"), turn.alias("one")).groupBy("id").agg(
        F.sort_array(F.collect_list("one")).alias("turns")
    )

    def piece(one: Column, i: Column) -> Column:
        last = F.size("turns") - 1
        joined = (i > 0) & (F.get("turns", i - 1)["role"] == one["role"])
        followed = (i < last) & (F.get("turns", i + 1)["role"] == one["role"])
        role = F.replace(escaped(one["role"]), F.lit("\n"), F.lit("\\\n"))
        return F.struct(
            F.when(joined, F.lit(AND)).otherwise(F.concat(F.lit(TURN), role, F.lit("\n"))).alias("head"),
            escaped(one["text"]).alias("body"),
            F.when(followed, F.lit("")).otherwise(F.lit(END)).alias("tail"),
            one["role"].isin(*trained).alias("trained"),
        )

    def run(one: Column) -> Column:
        head, body, tail = (F.char_length(one[k]) for k in ("head", "body", "tail"))
        return F.struct(
            F.when(one["trained"], head).otherwise(head + body + tail).alias("before"),
            F.when(one["trained"], body).otherwise(0).alias("under"),
            F.when(one["trained"], tail).otherwise(0).alias("after"),
        )

    pieces = sorted_turns.select("id", F.transform("turns", piece).alias("pieces"))
    return pieces.select(
        "id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.transform("pieces", run).alias("mask"),
    )


def read_back(formatted_rows: DataFrame) -> DataFrame:
    """``id``, ``formatted``, ``turns`` (array of structs role, text) and ``loss_texts``,
    both read from ``formatted`` (and ``mask``) alone."""
    block = r"(?s)^<\|turn\|>((?:[^\\\n]++|\\.)*+)\n(.*)<\|end\|>\n$"

    def block_turns(one: Column) -> Column:
        role = unescaped(F.regexp_extract(one, block, 1))
        texts = F.split(F.regexp_extract(one, block, 2), r"<\|and\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    cut = formatted_rows.withColumns(
        {
            "blocks": F.split("formatted", r"(?=<\|turn\|>)"),
            "pieces": F.split("formatted", r"(?=<\|turn\|>|<\|and\|>)"),
        }
    )
    under = F.transform("pieces", lambda p, i: F.substr(p, F.get("mask", i)["before"] + 1, F.get("mask", i)["under"]))
    marked = F.filter(F.arrays_zip(under.alias("text"), F.col("mask").alias("mask")), lambda z: z["mask"]["under"] > 0)
    return cut.select(
        "id",
        "formatted",
        F.flatten(F.transform("blocks", block_turns)).alias("turns"),
        F.transform(marked, lambda z: unescaped(z["text"])).alias("loss_texts"),
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    found = read_back(formatted(turns.unionByName(probe)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return found.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


_ESCAPED_SQL = "replace({0}, chr(92), repeat(chr(92), 2))"
for _control in CONTROLS:
    _ESCAPED_SQL = f"replace({_ESCAPED_SQL}, '{_control}', '{_control[0]}' || chr(92) || '{_control[1:]}')"

OP7_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}'
  UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}'
), placed AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS joined,
         replace({_ESCAPED_SQL.format('role')}, chr(10), chr(92) || chr(10)) AS shown_role, {_ESCAPED_SQL.format('text')} AS shown
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(shown) + CASE WHEN joined THEN {len(AND)} ELSE {len(TURN) + 1 + len(END)} + length(shown_role) END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
