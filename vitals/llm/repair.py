"""Conversation structure repair: the cheapest edits that give turns a legal order.

Rows of a conversation are taken by turn (null first), then role, then text. A row is
faulty if it is blank, repeats an earlier row, or ends without ``.``, ``!`` or ``?``. The
edits keep a row, change its role, delete it, or insert an empty turn; they must leave
roles whose initials read ``(s?(ua)+)?``. Of the cheapest edit lists the one whose
initials (the audit, of D, I, K and R) come first in ASCII order is taken.

The edits form a lattice: rows consumed by four states of the role order. It is searched
by a bidirectional Dijkstra: a forward and a reverse heap grow towards each other, all
crossings of the least cost are finished, and the least concatenated audit is picked.
Audits of one cost to one node are never prefixes of each other (an insertion costs
something), so the least halves make the least whole.

Conversations of any length: the rows are sorted by range, so a long conversation is dealt
over many tasks. A task cuts its rows into blocks of ``block_rows`` at most. A conversation
that lies in one block is solved there. Of other blocks the cheapest edits between each pair
of states are found; these small tables are folded in order, a stream per conversation that
holds four candidates, and each block then applies its share of the edits. Only an audit
and a digest are as long as their conversation.

Defined results: null roles and texts count as one space; rows with a null id make one
conversation; a null turn comes first and has no part in the gaps; repeated rows are
duplicates (the first is none); an empty table gives no rows; a blank row is not also a
duplicate, a duplicate not also truncated. Very long texts are only measured and hashed.
Only the four columns named are read, so others of any name do no harm.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.llm.common import table, written

SPACES = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 256  # rows of a block; an audit in the search is that long, about

# The states of ``(s?(ua)+)?`` by the role last seen, and the costs of edits
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWING = (USER, USER, ASSISTANT, USER)  # the state after an inserted or re-roled turn
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
LEGAL_END = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
CLEAN, DROP, CUT = range(3)  # what is wrong with a row: nothing, blank or duplicate, truncated

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def symbol(initial: str, fault: int) -> str:
    """All that the search has to know of a row, as one character."""
    return "ABCDEFGHIJKL"[("sua".find(initial) if initial else -1) % 4 * 3 + fault]


def _edges(code: str, state: int) -> Iterator[tuple[int, int, str]]:
    """(following state, cost, initial) of the edits that consume a row."""
    kind, fault = divmod("ABCDEFGHIJKL".index(code), 3)
    yield state, DELETE, "D"
    if fault != DROP:
        extra = TRUNCATED if fault == CUT else 0
        kept = KEPT[state].get("sua?"[kind])
        if kept is not None:
            yield kept, extra, "K"
        yield FOLLOWING[state], REROLE + extra, "R"


# for each symbol and state, the edges that leave it and those that reach it
LEAVING = {c: [list(_edges(c, s)) for s in range(4)] for c in "ABCDEFGHIJKL"}
REACHING = {
    c: [[(s, cost, e) for s in range(4) for to, cost, e in out[s] if to == state] for state in range(4)]
    for c, out in LEAVING.items()
}
BEFORE = [[s for s in range(4) if FOLLOWING[s] == state] for state in range(4)]


def cheapest(symbols: str, enter: int, leave: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of ``symbols`` that lead from the state
    ``enter`` to one of ``leave`` (ties: least audit); None if no edits do."""
    n = len(symbols)
    # nodes are numbered 4 * row + state. Of equal costs the heaps take nodes by their rows, so that
    # free edges (kept rows) are followed before a later node of that cost is settled.
    ahead, behind = {}, {}  # settled nodes: cost and audit
    forward, reverse = [(0, enter, "")], [(0, 0, s, "") for s in sorted(leave)]
    best: list = [None]

    def offer(cost: int, audit: str) -> None:
        if best[0] is None or (cost, audit) < best[0]:
            best[0] = (cost, audit)

    while forward and reverse:
        if best[0] is not None and forward[0][0] + reverse[0][0] > best[0][0]:
            break
        if ahead and reverse[0][0] <= forward[0][0]:  # both ends are settled first
            cost, back, state, audit = heappop(reverse)
            node = 4 * (n - back) + state
            if node in behind:
                continue
            behind[node] = cost, audit
            if node in ahead:
                offer(cost + ahead[node][0], ahead[node][1] + audit)
            steps = [(0, s, INSERT, "I") for s in BEFORE[state]]
            if back < n:
                steps += [(1, s, extra, e) for s, extra, e in REACHING[symbols[n - back - 1]][state]]
            for rows, s, extra, e in steps:
                other = ahead.get(4 * (n - back - rows) + s)
                if other is not None:
                    offer(other[0] + extra + cost, other[1] + e + audit)
                if 4 * (n - back - rows) + s not in behind:
                    heappush(reverse, (cost + extra, back + rows, s, e + audit))
        else:
            cost, node, audit = heappop(forward)
            if node in ahead:
                continue
            ahead[node] = cost, audit
            if node in behind:
                offer(cost + behind[node][0], audit + behind[node][1])
            row, state = divmod(node, 4)
            steps = [(node - state + FOLLOWING[state], INSERT, "I")]
            if row < n:
                steps += [(4 * (row + 1) + s, extra, e) for s, extra, e in LEAVING[symbols[row]][state]]
            for to, extra, e in steps:
                other = behind.get(to)
                if other is not None:
                    offer(cost + extra + other[0], audit + e + other[1])
                if to not in ahead:
                    heappush(forward, (cost + extra, to, audit + e))
    return best[0]


def applied(rows: list[dict], audit: str, state: int = START) -> list[dict]:
    """The turns (role, text) that ``audit`` makes of ``rows``."""
    out, i = [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        role = "user" if FOLLOWING[state] == USER else "assistant"
        if edit == "I":
            state = FOLLOWING[state]
            out.append({"role": role, "text": ""})
            continue
        row = rows[i]
        i += 1
        if edit == "K":
            state, role = KEPT[state][row["role"][0]], row["role"]
        else:
            state = FOLLOWING[state]
        out.append({"role": role, "text": row["text"]})
    return out


TURNS = "array<struct<role string, text string>>"
MEASURES = "first_turn bigint, last_turn bigint, n_turns bigint, initials string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
EDITS = "cost bigint, audit string"


def _measured(rows: list[dict], before: dict | None) -> tuple[dict, str]:
    """Counters of a block and its symbols; ``before`` is the row in front of it."""
    m = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    symbols, known, initials = [], [], []
    for row in rows:
        same = before is not None and all(before[k] == row[k] for k in ("turn", "role", "text"))
        fault = CLEAN
        if row["blank"]:
            m["blank"] += 1
            fault = DROP
        elif row["seen"] or same:
            m["duplicate"] += 1
            fault = DROP
        elif row["cut"]:
            m["truncated"] += 1
            fault = CUT
        initial = row["role"][:1]
        if initials and initials[-1] + initial not in LEGAL_PAIRS:
            m["illegal"] += 1
        initials.append(initial)
        symbols.append(symbol(initial, fault))
        if row["turn"] is not None and (not known or known[-1] != row["turn"]):
            known.append(row["turn"])
        before = row
    m |= {"first_turn": known[0] if known else None, "last_turn": known[-1] if known else None, "n_turns": len(known)}
    # an empty role has no initial: a line break stands for it
    m["initials"] = (initials[0] or "\n") + (initials[-1] or "\n")
    return m, "".join(symbols)


def blocks(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, block_rows: int) -> DataFrame:
    """The sorted rows in blocks. ``closed`` ones hold a whole conversation, repaired: ``turns``,
    ``cost`` and ``audit``. The others hold their rows in ``turns`` and the cheapest edits
    between states in ``ways``. ``place`` orders the blocks."""
    spaced = [F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col)]
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).cast("bigint").alias("turn"), spaced[0].alias("role"), spaced[1].alias("text"))
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    name = F.when(F.col("id").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("id").cast("string")))
    told = F.concat(F.length(name), F.lit(":"), name, F.length("role"), F.lit(":"), "role", "text")
    rows = rows.select(
        "*",
        (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(told, 256)).alias("mark"),
    )
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"))  # null before all others
    repeated = rows.groupBy("mark").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = F.coalesce(F.col("first.turn") < F.col("turn"), F.col("first").isNotNull() & F.col("first.turn").isNull() & F.col("turn").isNotNull())
    order = ["id", "turn", "role", "text"]
    placed = rows.join(repeated.select("mark", "first"), "mark", "left").select(*order, "blank", "cut", seen.alias("seen"))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    ways = "array<struct<enter int, leave int, cost bigint, audit string>>"
    out = T.StructType([placed.schema["id"], *T._parse_datatype_string(f"place bigint, closed boolean, {MEASURES}, {EDITS}, turns {TURNS}, ways {ways}").fields])
    arrow_schema = _arrow(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, found = TaskContext.get().partitionId(), 0, []
        solve = lru_cache(maxsize=20_000)(cheapest)  # most conversations are short and alike

        def block(rows: list[dict], before: dict | None, begins: bool, ends: bool) -> None:
            nonlocal made
            measures, symbols = _measured(rows, before)
            own = {"id": rows[0]["id"], "place": part << 32 | made, "closed": begins and ends, **measures}
            made += 1
            if own["closed"]:
                own["cost"], own["audit"] = solve(symbols, START, LEGAL_END)
                own["turns"] = applied(rows, own["audit"])
            else:
                pairs = [(e, s, solve(symbols, e, (s,))) for e in range(4) for s in range(4)]
                own["ways"] = [{"enter": e, "leave": s, "cost": x[0], "audit": x[1]} for e, s, x in pairs if x]
                own["turns"] = [{"role": r["role"], "text": r["text"]} for r in rows]
            found.append(own)

        run, before, begins, started = [], None, False, False
        for batch in batches:
            for row in batch.to_pylist():
                if run and run[-1]["id"] != row["id"] or not run and before is not None and before["id"] != row["id"]:
                    if run:
                        block(run, before, begins, True)
                    run, before, begins = [], None, True
                elif len(run) == block_rows:
                    block(run, before, begins, False)
                    run, before, begins = [], run[-1], False
                run.append(row)
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=arrow_schema)
                found.clear()
        if run:
            block(run, before, begins, False)
            yield pa.RecordBatch.from_pylist(found, schema=arrow_schema)

    return placed.mapInArrow(cut, out)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _folded(opened: DataFrame) -> DataFrame:
    """One row for each conversation of several blocks: its measures, cost, audit, and the
    ``parts`` (place, entry state, audit) that its blocks apply."""
    schema = T.StructType([opened.schema["id"], *T._parse_datatype_string(f"{MEASURES}, {EDITS}, parts array<struct<place bigint, enter int, audit string>>").fields])
    arrow_schema = _arrow(schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reached = None, {}

        def finish() -> pa.RecordBatch:
            cost, audit, parts = min((reached[s] for s in LEGAL_END if s in reached), key=lambda x: x[:2])
            chain = []
            while parts:
                parts, part = parts
                chain.append(part)
            return pa.RecordBatch.from_pylist([own | {"cost": cost, "audit": audit, "parts": chain[::-1]}], schema=arrow_schema)

        for batch in batches:
            for row in batch.to_pylist():
                place, ways = row.pop("place"), row.pop("ways")
                if own is None or own["id"] != row["id"]:
                    if own is not None:
                        yield finish()
                    own, reached = row, {START: (0, "", None)}
                else:
                    pair = (own["initials"][1] + row["initials"][0]).replace("\n", "")
                    for k in ("blank", "duplicate", "truncated", "illegal"):
                        own[k] += row[k]
                    own["illegal"] += pair not in LEGAL_PAIRS
                    own["initials"] = own["initials"][0] + row["initials"][1]
                    own["n_turns"] += row["n_turns"] - (own["last_turn"] is not None and own["last_turn"] == row["first_turn"])
                    if own["first_turn"] is None:
                        own["first_turn"] = row["first_turn"]
                    if row["last_turn"] is not None:
                        own["last_turn"] = row["last_turn"]
                following = {}
                for way in ways:
                    if way["enter"] in reached:
                        cost, audit, parts = reached[way["enter"]]
                        found = (cost + way["cost"], audit + way["audit"], (parts, {"place": place, "enter": way["enter"], "audit": way["audit"]}))
                        old = following.get(way["leave"])
                        if old is None or found[:2] < old[:2]:
                            following[way["leave"]] = found
                reached = following
        if own is not None:
            yield finish()

    needed = opened.select("id", "place", *[f.split()[0] for f in MEASURES.split(", ")], "ways")
    return needed.repartition("id").sortWithinPartitions("id", "place").mapInArrow(fold, schema)


def repaired(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(conversations, pieces).

    ``conversations`` has a row for each id with rows: ``id``, the counters ``gaps, blank,
    duplicate, truncated, illegal``, ``cost`` and ``audit``. ``pieces`` has the repaired
    turns: ``id``, ``place``, ``turns`` (array of role and text) and ``whole`` (the
    piece is all of the conversation); others are put together in the order of ``place``.
    """
    found = written(blocks(turns, id_col, turn_col, role_col, text_col, block_rows), "blocks")
    closed, opened = found.where("closed"), found.where("not closed")
    folded = written(_folded(opened), "folded")
    columns = ["id", *[f.split()[0] for f in MEASURES.split(", ")], "cost", "audit"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    conversations = closed.select(*columns).unionByName(folded.select(*columns)).select("id", gaps.alias("gaps"), *COUNTS[1:], "audit")
    parts = folded.select(F.inline("parts"))
    schema = T.StructType([found.schema["id"], *T._parse_datatype_string(f"place bigint, turns {TURNS}").fields])
    arrow_schema = _arrow(schema)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"id": r["id"], "place": r["place"], "turns": applied(r["turns"], r["audit"], r["enter"])}
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    edited = opened.select("id", "place", "turns").join(parts, "place").select("id", "place", "turns", "enter", "audit").mapInArrow(edit, schema)
    pieces = closed.select("id", "place", "turns", F.lit(True).alias("whole")).unionByName(edited.withColumn("whole", F.lit(False)))
    return conversations, pieces


def digests(pieces: DataFrame) -> DataFrame:
    """``id`` and ``digest``: SHA-256 of the lines ``role:text`` of each conversation. Whole
    pieces need no shuffle; those of longer ones are read in order as a stream."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.where("whole").select("id", F.sha2(lines, 256).alias("digest"))
    schema = T.StructType([pieces.schema["id"], T.StructField("digest", T.StringType())])
    arrow_schema = _arrow(schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, begun = None, None, False
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["id"] != last:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"id": last, "digest": state.hexdigest()}], schema=arrow_schema)
                    last, state, begun = row["id"], hashlib.sha256(), False
                if row["lines"] is not None:  # null: the piece has no turn left
                    state.update((("\n" if begun else "") + row["lines"]).encode())
                    begun = True
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"id": last, "digest": state.hexdigest()}], schema=arrow_schema)

    some = F.when(F.size("turns") > 0, lines).alias("lines")
    rest = pieces.where("not whole").select("id", "place", some).repartition("id").sortWithinPartitions("id", "place")
    return whole.unionByName(rest.select("id", "lines").mapInArrow(stream, schema))


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20 (nulls are one space)."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(damage == 1, "").when(damage == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(damage == 4, "user").otherwise(spaced("role"))
    copies = F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = turns.where(damage != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return kept.drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    conversations, pieces = repaired(damaged(turns), block_rows=block_rows)
    ids = turns.select("conv_id").distinct()
    named = conversations.select(F.col("id").alias("found_id"), *COUNTS, "audit")
    hashed = digests(pieces).select(F.col("id").alias("digest_id"), "digest")
    joined = ids.join(named, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    joined = joined.join(hashed, F.col("conv_id").eqNullSafe(F.col("digest_id")), "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same by dynamic programming: a row of ``step`` holds for each state the least key
    (nine digits of cost, then the audit) with its repaired lines, each after a line break."""

    def add(state: str, cost: str, edit: str, lines: str) -> str:
        total = f"least(left({state}.k, 9)::BIGINT + {cost}, 900000000)::VARCHAR"
        return f"{{'k': lpad({total}, 9, '0') || substr({state}.k, 10) || '{edit}', 't': {state}.t || {lines}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    inserted = [
        "s0", "s1",
        least("s2", *[add(s, "2", "I", user) for s in ("s0", "s1", "s3")]),
        least("s3", add("s2", "2", "I", assistant), *[add(s, "4", "II", f"{user} || {assistant}") for s in ("s0", "s1")]),
    ]

    def kept(state: str, initial: str) -> str:
        return add(state, f"CASE WHEN left(role, 1) = '{initial}' THEN extra ELSE 100000000 END", "K", "chr(10) || role || ':' || text")

    def reroled(state: str, role: str) -> str:
        return add(state, "2 + extra", "R", f"{role} || text")

    deleted = [add(f"c{s}", "3", "D", "''") for s in range(4)]
    consumed = [
        deleted[0],
        least(deleted[1], kept("c0", "s")),
        least(deleted[2], *[w for s in ("c0", "c1", "c3") for w in (kept(s, "u"), reroled(s, user))]),
        least(deleted[3], kept("c2", "a"), reroled("c2", assistant)),
    ]
    never = "{'k': '900000000', 't': ''}"
    states = ", ".join(f"{x} AS c{i}" for i, x in enumerate(inserted))
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
        string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS damage
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM given WHERE damage <> 0
), ordered AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) || left(role, 1) AS pair
  FROM hurt
), faulty AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
), measures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
), step AS (
  SELECT conv_id, 0::BIGINT AS i, {{'k': '000000000', 't': ''}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3
  FROM measures
  UNION ALL
  SELECT conv_id, i, {", ".join(consumed)}
  FROM (
    SELECT f.conv_id, f.i, f.role, f.text, {states},
      CASE fault WHEN 'truncated' THEN 1 WHEN '' THEN 0 ELSE 100000000 END AS extra
    FROM step JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM step.conv_id AND f.i = step.i + 1
  )
), solved AS (
  SELECT conv_id, gaps, blank, duplicate, truncated, illegal, {least("s0", inserted[3])} AS best
  FROM step JOIN measures m USING (conv_id) WHERE step.i = m.n
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(best.k, 9)::BIGINT, 0) AS cost,
  coalesce(substr(best.k, 10), '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN solved USING (conv_id)
"""


OP11_SQL = _sql()
