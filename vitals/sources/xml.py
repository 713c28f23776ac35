"""Export XML as rows: a positional scan for records and workouts in built-in expressions.

The file is read as text cut at every ``<`` (a raw ``<`` cannot stand inside an
attribute), so a row is one tag and the text behind it: a few hundred characters,
wherever the file is split. What a row means depends on what lies before it: it may be
inside a workout, a comment, a CDATA section or a processing instruction. Few tags change that:

1. One aggregation over the text keeps for each split only its *moves*: the tags that open
   or close a workout, and the beginnings and ends of what is no markup. A split is summed up
   by what its moves do to the state, from each state it may begin in (``Summary``).
2. Summaries are associative: the splits of a file are combined in groups, the groups in order,
   and then the splits of each group, so a file may have any number of splits.
3. With the state that each split begins in, a walk along its rows, in the task that reads them, tells which
   are inside a workout and which element is a child of which (``Walk``). Python sees numbers, no text.
   The rows that matter are written once; no row of text is shuffled.
4. The scan proper reads them by built-in functions. Only workouts that splits share, at most one
   for each cut through a file, are put together again: running depths tell their children.

Attributes as exports write them are cut out by position; any other legal spelling is read by
Spark's XML parser, one tag at a time, and what that refuses is malformed: raw ``&``, doubled
attributes, open quotes, and references to what is no character.

The places of rows hold for two scans of one listing with the same splits, so the scan runs
in a session of its own that fixes what decides on splits; the caller's settings are not touched.

``mode="dom"`` reads records with the built-in XML source instead (one task per file).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.schemas import CORRUPT, RECORD_ATTRIBUTES, RECORD_FIELDS, XML_RECORD_PARSE, XML_WORKOUT
from vitals.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

# What the scan yields: the seven record columns, which the other elements share
ELEMENT_FIELDS = {
    "Record": dict(zip(RECORD_ATTRIBUTES, RECORD_FIELDS)),
    "Workout": {
        "workoutActivityType": "type", "sourceName": "source_name", "durationUnit": "unit", "startDate": "start_date",
        "endDate": "end_date", "duration": "value",
    },
    "MetadataEntry": {"key": "type", "value": "value"},
    "WorkoutStatistics": {"type": "type", "sum": "value"},
}
KINDS = {"Workout": "workout", "MetadataEntry": "metadata", "WorkoutStatistics": "statistics"}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a key without a value
GROUP_SPLITS = 256  # splits of a file that are combined together

# Attributes that exports have besides (HealthKit's DTD); others may be there too
OTHER_ATTRIBUTES = {
    "Record": ("sourceVersion", "device"),
    "Workout": (
        "totalDistance", "totalDistanceUnit", "totalEnergyBurned", "totalEnergyBurnedUnit", "sourceVersion", "device",
        "creationDate",
    ),
    "MetadataEntry": (),
    "WorkoutStatistics": ("startDate", "endDate", "average", "minimum", "maximum", "unit"),
}

# A tag up to its end, with quotes closed; the second group is its attributes
TAG = r"""^([^\s/>"']+)((?:[^"'>/]++|/(?!>)|"[^"]*+"|'[^']*+')*+)/?>"""
CLOSED_TAG = r"""^(?:[^"'>/]++|/(?!>)|"[^"]*+"|'[^']*+')*+/>"""
# Attributes, and the text behind the tag, as exports write them
PLAIN_TAG = r"""^(?: [A-Za-z_:][\w:.-]*+="[^"\t\n\r]*+")*+ ?/?>[^">]*$"""
NAME = r''' ([A-Za-z_:][\w:.-]*+)="[^"]*+"'''
LEADING = r"^\s*[\t\n\r]\s*"
ODD_REFERENCE = "&(?!(?:lt|gt|amp|quot|apos);)"
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


# ------------------------------------------------------------ the state along a file


ACTIONS = "-WwxCDP"


def unpacked(moves) -> list[tuple[int, str, int]]:
    """(row, action, ends) of packed moves."""
    return [(m >> 6, ACTIONS[m & 7], m >> 3 & 7) for m in map(int, moves)]


class Summary(list):
    """What a run of splits does to the state: for each of the modes N (markup), C (comment), D (CDATA), P
    (processing instruction) that it may begin in, the mode it ends in, how many open
    workouts it closes, and which it leaves open."""

    MODES = "NCDP"

    @classmethod
    def of(cls, block: int, moves: list[tuple[int, str, int]]) -> Summary:
        return cls(run_of(block, moves, mode) for mode in cls.MODES)

    def then(self, other: Summary) -> Summary:
        """The summary of this run followed by ``other`` (associative)."""
        out = Summary()
        for finish, popped, pushed in self:
            end, closes, opens = other[self.MODES.index(finish)]
            left = max(0, len(pushed) - closes)
            out.append([end, popped + max(0, closes - len(pushed)), pushed[:left] + opens])
        return out

    def after(self, mode: str, stack: list[str]) -> tuple[str, list[str]]:
        """The state behind the run, from the state in front of it."""
        return Run(self[self.MODES.index(mode)]).after_one(stack)


class Run(list):
    """What a run of splits does to the state from one mode: mode it ends in, open workouts closed, workouts left open."""

    def after_one(self, stack: list[str]) -> tuple[str, list[str]]:
        finish, popped, pushed = self
        return finish, stack[: max(0, len(stack) - popped)] + pushed


def run_of(block: int, moves: list[tuple[int, str, int]], mode: str) -> Run:
    """What ``moves`` do to the state, beginning in ``mode``."""
    popped, pushed = 0, []
    for row, action, ends in moves:
        if mode != "N":
            if ends >> "CDP".index(mode) & 1:
                mode = "N"
        elif action == "W":
            pushed.append(f"{block}:{row}")
        elif action == "x":
            if pushed:
                pushed.pop()
            else:
                popped += 1
        elif action in "CDP":
            mode = action
    return Run([mode, popped, pushed])


def spans_of(block: int, first: int, last: int, moves, mode: str, stack: list[str]) -> Iterator[tuple[int, int, str | None]]:
    """(from row, to row, outermost workout) of the rows of a split inside a workout; None as
    workout: inside what is no markup. A workout's own tags are inside."""
    start, stack = first, list(stack)
    for row, action, ends in moves:
        if mode != "N":
            if ends >> "CDP".index(mode) & 1:
                yield start, row, None
                mode, start = "N", row + 1
        elif action == "W":
            if not stack:
                start = row
            stack.append(f"{block}:{row}")
        elif action == "w" and not stack:
            yield row, row, f"{block}:{row}"
        elif action == "x" and stack:
            outer = stack[0]
            stack.pop()
            if not stack:
                yield start, row, outer
        elif action in "CDP":
            if stack:
                yield start, row, stack[0]
            mode, start = action, row + 1
    if start <= last and (mode != "N" or stack):
        yield start, last, None if mode != "N" else stack[0]

def starts_of(splits: DataFrame, reach: int) -> DataFrame:
    """``mode`` and ``stack`` in front of each split. ``splits`` has ``file``, ``block`` (the offset)
    and ``summary`` (text); ``reach`` is the bytes of a group of splits.

    A prefix scan in three small steps: the splits of a group are combined, the groups of a
    file are run through in order, and with what that gives the splits of each group.
    """
    grouped = splits.withColumn("part", F.floor(F.col("block") / reach).cast("bigint"))

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in rows.sort_values("block")["summary"]:
            one = Summary(json.loads(text))
            whole = one if whole is None else whole.then(one)
        return pd.DataFrame({"file": rows["file"].iloc[:1], "part": rows["part"].iloc[:1], "summary": [json.dumps(whole)]})

    def through_parts(rows: pd.DataFrame) -> pd.DataFrame:
        out, state = [], ("N", [])
        for part, text in rows.sort_values("part")[["part", "summary"]].itertuples(index=False):
            out.append((rows["file"].iloc[0], part, *state))
            state = Summary(json.loads(text)).after(*state)
        return pd.DataFrame(out, columns=["file", "part", "mode", "stack"])

    def through_splits(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        out, state = [], (rows["mode"].iloc[0], list(rows["stack"].iloc[0]))
        for block, text in rows[["block", "summary"]].itertuples(index=False):
            out.append((rows["file"].iloc[0], block, *state))
            state = Summary(json.loads(text)).after(*state)
        return pd.DataFrame(out, columns=["file", "block", "mode", "stack"])

    parts = grouped.groupBy("file", "part").applyInPandas(combine, "file bigint, part bigint, summary string")
    begins = parts.groupBy("file").applyInPandas(through_parts, "file bigint, part bigint, mode string, stack array<string>")
    own = grouped.select("file", "part", "block", "summary").join(begins, ["file", "part"])
    return own.groupBy("file", "part").applyInPandas(through_splits, "file bigint, block bigint, mode string, stack array<string>")


# ------------------------------------------------------------ rows of text


def _keys(df: DataFrame, known: set[str]) -> list[str]:
    """Columns that a partitioned folder layout adds (``landing/user_id=7/...``)."""
    return [c for c in df.columns if c not in known]


def _scan_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings in which splits stay the same however many executors
    there are, and key folders are text (``01`` and ``1`` are two entities)."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    own.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))
    return own


def _text(spark: SparkSession, path: str) -> DataFrame:
    """Rows cut at ``<`` with their file, the place of their split, and a number that grows along a split."""
    try:
        chunks = spark.read.option("lineSep", "<").text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"export not found: {path}") from e
        raise
    keys = _keys(chunks, {"value"})
    # a file goes by the hash of its path: eight bytes a row instead of the path
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    row = F.monotonically_increasing_id().alias("row")
    return chunks.select(*[F.col(k).cast("string").alias(k) for k in keys], *place, row, "value")


def _cut(value: Column) -> Column:
    """The pieces of a row between its ``>``: two for nearly all tags, and then the end of the first one tells
    how the tag ends, without another search along the row."""
    return F.split(value, ">")


def _closed(value: Column, cut: Column) -> Column:
    """Whether an open tag closes itself; ``cut`` is its ``_cut``."""
    loose = ~value.rlike(TAG) & value.rlike("^[^>]*/>")  # quotes that do not match: up to the first >
    return F.when(F.size(cut) == 2, F.get(cut, F.lit(0)).endswith("/")).otherwise(value.rlike(CLOSED_TAG) | loose)


def _is_tag(value: Column, name: str) -> Column:
    return value.startswith(name) & value.rlike(rf"^{name}(?:[\s/>]|$)")


def _move(v: Column, cut: Column) -> Column:
    """The action of a row on the state and the ends in it, as one number (``unpacked`` without the row)."""
    first = F.get(cut, F.lit(0))

    def begins(start: str, end: str, mode: str) -> Column:
        return F.when(F.substr(v, F.lit(len(start) + 1)).contains(end), "-").otherwise(mode)

    def has(end: str) -> Column:
        return F.when(F.size(cut) == 2, first.endswith(end[:-1])).otherwise(v.contains(end)).cast("int")

    action = (
        F.when(v.startswith("!--"), begins("!--", "-->", "C"))
        .when(v.startswith("![CDATA["), begins("![CDATA[", "]]>", "D"))
        .when(v.startswith("?"), begins("?", "?>", "P"))
        .when(_is_tag(v, "Workout"), F.when(_closed(v, cut), "w").otherwise("W"))
        .when(v.startswith("/Workout") & v.rlike(r"^/Workout\s*(?:>|$)"), "x")
        .otherwise("-")
    )
    ends = has("-->") + has("]]>") * 2 + has("?>") * 4
    return F.instr(F.lit(ACTIONS), action) - 1 + F.lit(8) * ends


def _states(text: DataFrame) -> DataFrame:
    """``state`` (text) of the splits of ``text`` that begin inside something, or that leave open a workout which a
    later split begins in: a row or two for each place where a file is cut. See ``Walk``."""
    spark = text.sparkSession
    v, cut = F.col("value"), F.col("cut")
    told = _once(text.select("file", "block", "row", "value"), _cut(v).alias("cut")).select("file", "block", "row", _move(v, cut).alias("code"))
    told = told.select("file", "block", "row", F.inline(F.array(F.struct("code"))))
    move = F.when(F.col("code") > 0, F.shiftleft("row", 6) + F.col("code"))
    splits = told.groupBy("file", "block").agg(F.sort_array(F.collect_list(move)).alias("moves"))
    path = scratch_path(spark, "splits")
    splits.write.parquet(path)
    # small, but much work in Python for each row: not packed into few tasks
    splits = spark.read.schema(splits.schema).parquet(path).repartition(spark.sparkContext.defaultParallelism, "file", "block")

    @F.pandas_udf("string")
    def summary(blocks: pd.Series, moves: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(Summary.of(b, unpacked(own))) for b, own in zip(blocks, moves)], dtype=object)

    reach = GROUP_SPLITS * int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    starts = starts_of(splits.select("file", "block", summary("block", "moves").alias("summary")), reach)
    inside = starts.where((F.col("mode") != "N") | (F.size("stack") > 0)).select(
        "file", "block", "mode", F.size("stack").alias("depth"), F.get("stack", F.lit(0)).alias("outer")
    )
    path = scratch_path(spark, "starts")
    inside.write.parquet(path)
    inside = spark.read.schema(inside.schema).parquet(path)
    # a workout that goes on in a later split is marked in the split where it begins
    begun = F.split_part("outer", F.lit(":"), F.lit(1)).cast("bigint").alias("block")
    leaves = inside.where(F.col("outer").isNotNull()).select("file", begun, F.col("outer").alias("leaves"))
    both = inside.select("file", "block", "mode", "depth", "outer").unionByName(leaves, allowMissingColumns=True)
    state = both.groupBy("file", "block").agg(*[F.max(c).alias(c) for c in ("mode", "depth", "outer", "leaves")])
    return state.select("file", "block", F.to_json(F.struct("mode", "depth", "outer", "leaves")).alias("state"))


class Walk:
    """The state along the rows of a split, from the one it begins with: tells each row its lane and its link.

    Lane OUTSIDE is neither in a workout nor in what is no markup, NO_MARKUP the latter. CHILD is an open tag that
    counts inside a workout that begins and ends in the split; its link is the workout it is a child of. CROSSING is
    every row of a workout that other splits share; its link is the outermost workout.
    """

    OUTSIDE, NO_MARKUP, CHILD, CROSSING = range(4)

    def __init__(self, block: int, state: str | None):
        begin = json.loads(state) if state else {}
        self.block, self.mode = block, begin.get("mode") or "N"
        self.stack = [begin.get("outer")] * (begin.get("depth") or 0)
        self.shared = {begin.get("outer"), begin.get("leaves")}
        self.outer, self.depth, self.parents = None, 0, {}

    def through(self, first: int, codes: np.ndarray) -> tuple[np.ndarray, list | None]:
        """Goes on by rows numbered from ``first`` on, whose ``codes`` are known: their lanes, and links if any."""
        lanes, links = np.zeros(len(codes), "int32"), None
        at = (codes & 63).nonzero()[0]
        moves = [(first + i, ACTIONS[c & 7], c >> 3 & 7) for i, c in zip(at.tolist(), codes[at].tolist())]
        for lo, hi, outer in spans_of(self.block, first, first + len(codes) - 1, moves, self.mode, self.stack):
            lo, hi, links = lo - first, hi - first + 1, links or [None] * len(codes)
            if outer is None:
                lanes[lo:hi] = self.NO_MARKUP
            elif outer in self.shared:
                lanes[lo:hi], links[lo:hi] = self.CROSSING, [outer] * (hi - lo)
            else:
                lanes[lo:hi] = self._inside(outer, first + lo, codes[lo:hi].tolist(), links, lo)
        self.mode, self.stack = run_of(self.block, moves, self.mode).after_one(self.stack)
        return lanes, links

    def _inside(self, outer: str, first: int, codes: list[int], links: list, lo: int) -> list[int]:
        """The lanes of rows of one workout; their links go to ``links`` from ``lo`` on."""
        if outer != self.outer:
            self.outer, self.depth, self.parents = outer, 0, {}
        lanes = [self.NO_MARKUP] * len(codes)
        for i, code in enumerate(codes):
            kind = code >> 6
            if not kind:
                continue
            step = (kind & 3) - 2
            if step >= 0 and kind & 4:
                parent = self.parents.get(self.depth, "")
                if parent or kind & 8:
                    lanes[i], links[lo + i] = self.CHILD, parent
            if step > 0:  # the parent of what follows one level deeper, up to the next one of its level
                self.parents[self.depth + 1] = f"{self.block}:{first + i}" if kind & 16 else ""
            self.depth += step
        return lanes


def _name(v: Column) -> Column:
    out = F.regexp_extract(v, r"^/?([A-Za-z_:][-\w:.]*)", 1)
    for element in ELEMENT_FIELDS:  # most rows
        out = F.when(v.startswith(f"{element} "), element).otherwise(out)
    return out


def _step(v: Column, cut: Column) -> Column:
    """What a tag does to the depth."""
    return F.when(v.startswith("/"), -1).when(_closed(v, cut), 0).otherwise(1)


def _placed(text: DataFrame, keys: list[str], outside: bool) -> DataFrame:
    """The rows of ``text`` that elements come from, with their ``lane`` and ``link`` (``Walk``): written once to the
    shared folder, those outside workouts only if asked for. Rows stay in the tasks that read them, in their order;
    Python gets their numbers, no text.

    The states are joined by broadcast: a row or two for each cut through a file, and any other join
    would deal the rows anew.
    """
    spark, v = text.sparkSession, F.col("value")
    states = F.broadcast(_states(text))

    @F.arrow_udf("struct<lane int, link string>")
    def walk(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        at, along = None, None
        for files, blocks, rows, codes, states in batches:
            f, b, codes = files.to_numpy(), blocks.to_numpy(), codes.to_numpy()
            cuts = (((f[1:] != f[:-1]) | (b[1:] != b[:-1])).nonzero()[0] + 1).tolist()
            lanes, links = [np.zeros(0, "int32")], [pa.nulls(0, pa.string())]
            for lo, hi in zip([0, *cuts], [*cuts, len(codes)] if len(codes) else []):
                if at != (f[lo], b[lo]):
                    at = (f[lo], b[lo])
                    along = Walk(int(b[lo]), states[lo].as_py())
                own, linked = along.through(rows[lo].as_py(), codes[lo:hi])
                lanes.append(own)
                links.append(pa.nulls(hi - lo, pa.string()) if linked is None else pa.array(linked, pa.string()))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(lanes)), pa.concat_arrays(links)], ["lane", "link"])

    walk = walk.asNondeterministic()  # it sees every row, whatever is asked for afterwards
    name = F.col("name")
    cut = F.col("cut")
    named = _once(text, _name(v).alias("name"), _cut(v).alias("cut"))
    kind = F.when(
        name != "",
        _step(v, cut) + 2 + name.isin(*ELEMENT_FIELDS).cast("int") * 4 + name.isin("Workout", "Record").cast("int") * 8 + (name == "Workout").cast("int") * 16,
    ).otherwise(0)
    coded = _once(named, (_move(v, cut) + kind * 64).cast("int").alias("code")).join(states, ["file", "block"], "left")
    told = coded.select(*keys, "file", "block", "row", "value", "name", walk("file", "block", "row", "code", "state").alias("place"))
    told = told.select(*keys, "file", "block", "row", "value", "name", "place.lane", "place.link")
    wanted = F.col("lane") >= Walk.CHILD
    if outside:
        wanted = wanted | ((F.col("lane") == Walk.OUTSIDE) & _is_tag(v, "Record"))
    wanted = told.where(wanted)
    path = scratch_path(spark, "tags")
    wanted.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(wanted.schema).parquet(path)


# ------------------------------------------------------------ attributes


def _decoded(value: Column) -> Column:
    out = value
    for entity, char in NAMED:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(value.contains("&"), out).otherwise(value)


def _once(rows: DataFrame, *columns: Column) -> DataFrame:
    """``rows`` with ``columns``, made by a generator over one row, which no later step repeats."""
    return rows.select("*", F.inline(F.array(F.struct(*columns))))


def _usual(rows: DataFrame, name: Column, elements: list[str], places) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with ``body`` (the tag behind its name) and ``usual``, and the values of the fields where that is true: the
    tag reads as ``PLAIN_TAG`` says, its names are known ones and no two are alike. Pieces cut at ``>`` and ``"`` tell it."""
    # by bytes: names are ASCII
    body = F.substr(F.col("value").cast("binary"), F.octet_length(name) + 1).cast("string")
    rows = _once(rows, body.alias("body"))
    rows = _once(rows, _cut(F.col("body")).alias("cut"))
    head, behind, parts = F.get("cut", F.lit(0)), F.get("cut", F.lit(1)), F.col("parts")
    rows = _once(rows, F.when(F.size("cut") == 2, F.split(head, '"')).alias("parts"))

    def others(element: str) -> Column:
        return sum((F.array_position(parts, f" {a}=") % 2 for a in OTHER_ATTRIBUTES[element]), F.lit(0).cast("bigint"))

    more = others(elements[-1])
    for element in elements[:-1]:
        more = F.when(name == element, others(element)).otherwise(more)
    rows = _once(rows, F.coalesce(more, F.lit(0)).cast("int").alias("more"), *[x.alias(f"place_{f}") for f, x in places("parts").items()])
    # each known name counts once, and only at a place of names: all such places are taken by names that differ
    known = sum((F.col(f"place_{f}") % 2 for f in RECORD_FIELDS), F.col("more"))
    usual = (F.size("cut") == 2) & (known * 2 + 1 == F.size(parts)) & F.get(parts, F.size(parts) - 1).isin("", " ", "/", " /")
    usual = usual & ~behind.contains('"') & ~head.rlike("[\t\n\r]")
    usual = usual & ~(F.col("body").contains("&") & F.col("body").rlike(ODD_REFERENCE))
    values = {f: F.when(F.col(f"place_{f}") % 2 == 1, F.get(parts, F.col(f"place_{f}"))) for f in RECORD_FIELDS}
    return _once(rows, F.coalesce(usual, F.lit(False)).alias("usual")), values


def _with_fields(rows: DataFrame, name: Column, elements: list[str], keep: list[str]) -> DataFrame:
    """``keep``, the record fields of the open tag ``value`` of the element ``name``, one of ``elements``, and
    ``good``: the tag is well-formed (the fields are NULL if not)."""

    def attribute_of(field: str, around: str, pick) -> Column:
        """For each element ``pick`` of its attribute for ``field``; NULL without one."""
        out = F.lit(None).cast("string")
        for element in elements:
            for a, target in ELEMENT_FIELDS[element].items():
                if target == field:
                    out = pick(around.format(a)) if len(elements) == 1 else F.when(name == element, pick(around.format(a))).otherwise(out)
        return out

    def places(of: str) -> dict[str, Column]:
        """Where the names of the fields stand in the pieces ``of`` (name, value, name, value ...), from 1 on; 0: nowhere."""
        return {f: F.coalesce(F.array_position(of, attribute_of(f, " {}=", F.lit)), F.lit(0)).cast("int") for f in RECORD_FIELDS}

    rows, usual = _usual(rows, name, elements, places)
    # the others, by regular expressions
    rest = F.when(~F.col("usual"), F.when(F.col("body").rlike(LEADING), F.regexp_replace("body", LEADING, " ")).otherwise(F.col("body")))
    rows = _once(rows, rest.alias("rest"))  # a line break behind the name
    rows = _once(rows, F.split("rest", '"').alias("pieces"), F.regexp_extract_all("rest", F.lit(NAME), F.lit(1)).alias("names"))
    names = F.col("names")
    plain = F.col("rest").rlike(PLAIN_TAG) & (F.size(F.array_distinct(names)) == F.size(names))
    plain = plain & ~(F.col("rest").contains("&") & F.col("rest").rlike(ODD_REFERENCE))
    rows = _once(rows, plain.alias("distinct"), *[F.when(~F.col("usual"), x).alias(f"at_{f}") for f, x in places("pieces").items()])
    # a value that reads like a name (an even place) is not told from it here
    odd = reduce(Column.__or__, [(F.col(f"at_{f}") > 0) & (F.col(f"at_{f}") % 2 == 0) for f in RECORD_FIELDS])
    raw = {f: F.when(F.col("usual"), usual[f]).when(F.col(f"at_{f}") > 0, F.get("pieces", F.col(f"at_{f}"))) for f in RECORD_FIELDS}
    rows = _once(rows, (F.col("usual") | (F.col("distinct") & ~odd)).alias("plain"), *[x.alias(f"raw_{f}") for f, x in raw.items()])
    attributes = sorted({a for element in elements for a in ELEMENT_FIELDS[element]})
    schema = ", ".join([*(f"_{a} string" for a in attributes), f"{CORRUPT} string"])
    tag = F.concat(F.lit("<E"), F.regexp_extract("value", TAG, 2), F.lit("/>"))
    rows = _once(rows, F.when(~F.col("plain") & F.col("value").rlike(TAG), F.from_xml(tag, schema, XML_OPTIONS)).alias("parsed"))
    well = F.col("parsed").isNotNull() & F.col(f"parsed.{CORRUPT}").isNull()
    read = {f: F.when(well, attribute_of(f, "_{}", lambda a: F.col(f"parsed.{a}"))) for f in RECORD_FIELDS}
    fields = [
        F.when(F.col("plain"), _decoded(F.col(f"raw_{f}"))).otherwise(read[f]).alias(f"field_{f}") for f in RECORD_FIELDS
    ]
    return rows.select(*keep, *fields, (F.col("plain") | well).alias("good"))


def _fields() -> list[Column]:
    """The record columns; the text of a malformed tag as its value."""
    last = F.when(F.col("good"), F.col("field_value")).otherwise(F.col("value")).alias("value")
    return [*[F.col(f"field_{f}").alias(f) for f in RECORD_FIELDS if f != "value"], last]


def _records(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The records of ``rows``, well-formed or not."""
    found = _with_fields(rows, F.lit("Record"), ["Record"], [*keys, "file", "block", "row", "value"])
    kind = F.when(F.col("good"), "record").otherwise("malformed_record").alias("kind")
    return found.select(*_fields(), F.lit("").alias("workout"), "block", "row", kind, *keys, "file")


def _links(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The open tags among ``rows`` of workouts that splits share (``link`` names the outermost one) that count, and the
    workout each is a child of as ``link``; depths are running sums along the outermost workout."""
    v, name = F.col("value"), F.col("name")
    tags = _once(rows.where(name != ""), _step(v, _cut(v)).alias("step"))
    along = Window.partitionBy("file", "outer").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, 0)
    tags = tags.withColumnRenamed("link", "outer").withColumn("depth", F.sum("step").over(along) - F.col("step")).where("step >= 0")
    # an open element is the parent of what follows one level deeper, up to the next one of its level
    parent = F.when(name == "Workout", F.concat_ws(":", "block", "row")).otherwise("")
    none = F.lit(None).cast("string")
    roles = F.array_compact(
        F.array(
            F.when(name.isin(*ELEMENT_FIELDS), F.struct(F.col("depth").alias("level"), none.alias("opens"), v.alias("text"))),
            F.when(F.col("step") == 1, F.struct((F.col("depth") + 1).alias("level"), parent.alias("opens"), none.alias("text"))),
        )
    )
    met = tags.select(*keys, "file", "block", "row", "outer", "name", F.inline(roles))
    level = Window.partitionBy("file", "outer", "level").orderBy("block", "row", F.col("opens").isNotNull())
    level = level.rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("link", F.coalesce(F.last("opens", ignorenulls=True).over(level), F.lit("")))
    wanted = name.isin("Workout", "Record") | (F.col("link") != "")
    return met.where(F.col("opens").isNull() & wanted).withColumnRenamed("text", "value")


def _inside(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Records, workouts and direct children of workouts: ``rows`` are those in workouts, ``link`` the workout that
    each is a child of, if any."""
    found = _with_fields(rows, F.col("name"), list(ELEMENT_FIELDS), [*keys, "file", "block", "row", "value", "name", "link"])
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    well = F.when(F.col("name") == "Record", "nested").otherwise(kinds[F.col("name")])
    ill = F.concat(F.lit("malformed_"), F.coalesce(kinds[F.col("name")], F.lit("record")))
    workout = F.when(F.col("name") == "Workout", F.concat_ws(":", "block", "row")).otherwise(F.col("link")).alias("workout")
    return found.select(*_fields(), workout, "block", "row", F.when(F.col("good"), well).otherwise(ill).alias("kind"), *keys, "file")


# ------------------------------------------------------------ the scan


def _rows(spark: SparkSession, path: str, outside: bool) -> tuple[list[str], DataFrame, DataFrame]:
    """The keys, and the rows of elements outside workouts (records; none if not asked for) and inside."""
    text = _text(_scan_session(spark), path)
    keys = _keys(text, {"file", "block", "row", "value"})
    tags = _placed(text, keys, outside)
    columns = [*keys, "file", "block", "row", "value", "name", "link"]
    of = {lane: tags.where(F.col("lane") == lane).select(*columns) for lane in (Walk.OUTSIDE, Walk.CHILD, Walk.CROSSING)}
    inside = of[Walk.CHILD].unionByName(_links(of[Walk.CROSSING], keys).select(*columns))
    return keys, of[Walk.OUTSIDE], inside


def _lanes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The elements outside workouts (records), and those inside."""
    keys, outside, inside = _rows(spark, path, outside=True)
    return _records(outside, keys), _inside(inside, keys)


def scan_elements(spark: SparkSession, path: str) -> DataFrame:
    """Every record, workout, and child of a workout.

    ``kind`` is ``record`` (outside workouts), ``nested`` (a record inside one, at any
    depth), ``workout``, ``metadata`` or ``statistics`` (direct children of a workout), or
    one of these four that is ``malformed_`` (``value`` is then the text as it stands).
    ``workout`` names the workout within its file, ``block`` and ``row`` the place. The
    rows that elements come from are placed first, by jobs of their own.
    """
    outside, inside = _lanes(spark, path)
    return outside.unionByName(inside)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of the export(s) at ``path``, empty ones too: ``path`` and the folder keys. It is the listing
    that the driver holds for the scan."""
    text = _text(_scan_session(spark), path)
    keys = _keys(text, {"file", "block", "row", "value"})
    rows = []
    for file in text.inputFiles():
        folders = dict(part.split("=", 1) for part in unquote(file).split("/")[:-1] if "=" in part)
        own = [unquote(folders[k]) for k in keys]
        rows.append((*(None if k == NULL_FOLDER else k for k in own), file))
    return spark.createDataFrame(rows, ", ".join([*(f"`{k}` string" for k in keys), "path string"]))


def records_of(elements: DataFrame, kinds: tuple[str, ...] = ("record",)) -> DataFrame:
    """The records among ``elements``: the keys and seven text columns."""
    keys = _keys(elements, {*RECORD_FIELDS, "workout", "block", "row", "kind", "file"})
    return elements.where(F.col("kind").isin(*kinds)).select(*keys, *RECORD_FIELDS)


def workouts_of(elements: DataFrame) -> DataFrame:
    """The workouts among ``elements`` with their children (``XML_WORKOUT``, records left out).

    Only rows of workouts are shuffled; a group is one workout of one file.
    """
    keys = _keys(elements, {*RECORD_FIELDS, "workout", "block", "row", "kind", "file"})
    own = elements.where(F.col("kind").isin("workout", "malformed_workout", "metadata", "statistics"))
    kind = F.col("kind")
    attributes = F.struct("type", "value", "unit", "source_name", "start_date", "end_date")

    def children(name: str, second: str, wanted: str):
        one = F.when(kind == wanted, F.struct("block", "row", F.col("type").alias(name), F.col("value").alias(second)))
        array = F.sort_array(F.collect_list(one))
        return F.when(F.size(array) > 0, F.transform(array, lambda c: F.struct(c[name].alias(name), c[second].alias(second))))

    grouped = own.groupBy(*keys, "file", "workout").agg(
        F.max(F.when(kind == "workout", attributes)).alias("w"),
        children("_key", "_value", "metadata").alias("MetadataEntry"),
        children("_type", "_sum", "statistics").alias("WorkoutStatistics"),
    )
    return grouped.where(F.col("w").isNotNull()).select(
        *keys,
        F.col("w.type").alias("_workoutActivityType"),
        F.col("w.value").alias("_duration"),
        F.col("w.unit").alias("_durationUnit"),
        F.col("w.source_name").alias("_sourceName"),
        F.col("w.start_date").alias("_startDate"),
        F.col("w.end_date").alias("_endDate"),
        F.col("MetadataEntry").cast(XML_WORKOUT["MetadataEntry"].dataType).alias("MetadataEntry"),
        F.col("WorkoutStatistics").cast(XML_WORKOUT["WorkoutStatistics"].dataType).alias("WorkoutStatistics"),
    )


def scan_records(spark: SparkSession, path: str, mode: str = "split") -> DataFrame:
    """Every well-formed ``<Record>`` of the export(s) at ``path``, inside workouts or not:
    7 text columns. Missing attributes are NULL; the ``device`` attribute is not read."""
    if mode == "dom":
        raw = _scan_session(spark).read.format("xml").options(rowTag="Record", **XML_OPTIONS).schema(XML_RECORD_PARSE).load(path)
        keys = _keys(raw, set(XML_RECORD_PARSE.fieldNames()))
        # a malformed element has every field NULL; the test of a data column keeps one in the scan
        good = raw.where(~(F.col(CORRUPT).isNotNull() & F.col("_type").isNull()))
        columns = [F.col(f"_{a}").alias(f) for a, f in zip(RECORD_ATTRIBUTES, RECORD_FIELDS)]
        return good.select(*[F.col(k).cast("string").alias(k) for k in keys], *columns)
    return records_of(scan_elements(spark, path), ("record", "nested"))


def scan_workouts(spark: SparkSession, path: str) -> DataFrame:
    """Every well-formed ``<Workout>`` with its attributes and child arrays."""
    keys, _, inside = _rows(spark, path, outside=False)
    return workouts_of(_inside(inside, keys))


def _difference(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` less ``gone``, a part of them, as multisets.

    Rows are told by a hash of all columns. Those whose hash ``gone`` does not have stay as they are: they stream past
    the hashes of ``gone``, so no task holds or sorts them. The others, few if ``gone`` is small, are
    counted in full, so a hash that two rows share costs time only. Both joins read one shuffle of ``rows``.
    """
    mark = F.xxhash64(*rows.columns).alias("mark")
    marked = rows.select("*", mark)
    known = gone.select(mark).distinct().hint("shuffle_hash")
    other = marked.join(known, "mark", "left_anti").select(*rows.columns)
    alike = marked.join(known, "mark", "left_semi").select(*rows.columns)
    return other.unionByName(alike.exceptAll(gone.select(*rows.columns)))


def read_export(spark: SparkSession, path: str, mode: str = "split") -> tuple[DataFrame, DataFrame]:
    """(records outside workouts, workouts) of the export(s) at ``path``.

    With ``mode="dom"`` the records come from the built-in XML source, and the records
    inside workouts are taken off as a multiset difference. A missing path raises
    ``FileNotFoundError``.
    """
    if mode == "dom":
        keys, _, inside = _rows(spark, path, outside=False)
        nested = _inside(inside.where(F.col("name") == "Record"), keys)  # other elements are not parsed for it
        return _difference(scan_records(spark, path, "dom"), records_of(nested, ("nested",))), workouts_of(_inside(inside, keys))
    outside, inside = _lanes(spark, path)
    return records_of(outside), workouts_of(inside)
