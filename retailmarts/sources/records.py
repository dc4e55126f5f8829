"""Records of delimited files whose quoted text may hold line breaks, found by many tasks a file.

A line is either met outside quotes, where it starts a record, or inside.  Each line maps that state at its
start to the state at its end: it keeps it, flips it, or sets it to one of the two.  Such maps combine in
any grouping, so every byte range of a file sums its lines up under both assumptions; the ranges of a file,
one row each, are put in order to find the state each one really starts with.  The lines before a
range's first record then go to the range that the record started in, and all ranges are cut into records
side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmarts.functions import columns, once

FILE, RANGE, PLACE = "_file", "_range", "_place"
_RANGES = f"PARTITION BY {FILE}, {RANGE} ORDER BY {PLACE}"

# The fields of ``functions.text.csv_fields``: a quote opens a field only as its first character.  All
# quantifiers are possessive: linear time, no stack.
_INSIDE = r'(?:[^"]++|"")*+'
_CLOSED = rf'(?:"{_INSIDE}"[^,]*+,|(?!")[^,]*+,)*+'
_OPENS = rf'(?s)^{_CLOSED}"{_INSIDE}$'
_STAYS = rf'(?s)^{_INSIDE}(?:$|"[^,]*+,{_CLOSED}"{_INSIDE}$)'


def _effect(line: str) -> dict[str, str]:
    """``_flips`` (0 or 1) and ``_sets`` (the state a line sets whatever it was, else NULL): true is inside.

    A line without a quote keeps the state."""
    plain = f"instr({line}, '\"') = 0"
    return {
        "_opens": f"CASE WHEN {plain} THEN false ELSE {line} RLIKE r'{_OPENS}' END",
        "_stays": f"CASE WHEN {plain} THEN true ELSE {line} RLIKE r'{_STAYS}' END",
    }


_AS_STEP = {"_flips": "int(_opens AND NOT _stays)", "_sets": "CASE WHEN _opens = _stays THEN _opens END"}


def _before(start: str, window: str) -> str:
    """The state before a row whose earlier rows have the steps ``_flips`` and ``_sets``, and ``_turn``, the
    flips up to and with the row: the last state set, or ``start``, flipped as often as was since."""
    earlier = f"({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    turned = f"coalesce(lag(_turn) OVER ({window}), 0L)"
    last = f"last(CASE WHEN _sets IS NOT NULL THEN struct(_sets, _turn) END, true) OVER {earlier}"
    return f"CASE WHEN ({last}) IS NULL THEN {start} <> (({turned}) % 2 = 1)" \
           f" ELSE ({last})._sets <> ((({turned}) - ({last})._turn) % 2 = 1) END"


def _turns(rows: DataFrame, window: str) -> DataFrame:
    running = f"sum(_flips) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return rows.select("*", *columns(**_AS_STEP)).select("*", *columns(_turn=running))


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the file(s) at ``path``, ended by ``\\n`` or ``\\r\\n``, with their file, range and place."""
    return located(spark.read.option("lineSep", "\n").text(path).select("value", "_metadata.*"))


def located(lines: DataFrame, *keep: str) -> DataFrame:
    """Lines of a text source, read with the columns of ``_metadata``, in the form this module takes."""
    return lines.selectExpr(
        "CASE WHEN endswith(value, '\r') THEN left(value, length(value) - 1) ELSE value END AS line",
        f"file_path AS {FILE}", f"file_block_start AS {RANGE}", f"monotonically_increasing_id() AS {PLACE}", *keep,
    )


def _starts(lines: DataFrame) -> DataFrame:
    """One row per range: the place of its first record (NULL if it has none), and the range in which the
    record started that is open at its beginning.  Lines are read without their text."""
    effects = lines.select(FILE, RANGE, PLACE, once(**_effect("line")))
    both = _turns(effects, _RANGES).select(
        "*", *columns(_if_outside=_before("false", _RANGES), _if_inside=_before("true", _RANGES))
    )
    # The state after the last line of a range is that line's effect on the state before it.
    after = {s: f"max_by(CASE WHEN {s} THEN _stays ELSE _opens END, {PLACE})" for s in ("_if_outside", "_if_inside")}
    ranges = both.groupBy(FILE, RANGE).agg(*columns(
        _opens=after["_if_outside"], _stays=after["_if_inside"],
        _first_outside=f"min(CASE WHEN NOT _if_outside THEN {PLACE} END)",
        _first_inside=f"min(CASE WHEN NOT _if_inside THEN {PLACE} END)",
    ))
    of_file = f"PARTITION BY {FILE} ORDER BY {RANGE}"  # a row per range
    known = _turns(ranges, of_file).select("*", *columns(_inside=_before("false", of_file)))
    first = known.select(FILE, RANGE, *columns(_first="CASE WHEN _inside THEN _first_inside ELSE _first_outside END"))
    earlier = f"({of_file} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return first.select("*", *columns(_owner=f"last(CASE WHEN _first IS NOT NULL THEN {RANGE} END, true) OVER {earlier}"))


def records(lines: DataFrame, header: bool, *keep: str) -> DataFrame:
    """Rows ``line``, one per record, of ``file_lines``; line breaks inside are ``\\n``.

    With ``header`` the first record of each file is left out.  An unclosed quote runs to the end of its
    file.  ``keep`` are columns with one value per file, carried along."""
    owned = lines.join(_starts(lines), [FILE, RANGE]).withColumn(
        "_owner", F.expr(f"CASE WHEN {PLACE} >= _first THEN {RANGE} ELSE _owner END")
    )
    here = f"PARTITION BY {FILE}, _owner ORDER BY {RANGE}, {PLACE}"
    effects = owned.select(FILE, RANGE, PLACE, "_owner", *keep, once(line="line", **_effect("line")))
    begun = _turns(effects.repartition(FILE, "_owner"), here).select("*", *columns(_inside=_before("false", here)))
    numbered = begun.select("*", *columns(
        _number=f"sum(int(NOT _inside)) OVER ({here} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ))
    if header:
        numbered = numbered.where("NOT (_owner = 0 AND _number = 1)")
    joined = f"array_join(transform(sort_array(collect_list(struct({RANGE}, {PLACE}, line))), x -> x.line), '\\n')"
    whole = numbered.groupBy(FILE, "_owner", "_number").agg(*columns(
        line=joined, **{k: f"first({k})" for k in keep}
    ))
    return whole.select("line", *keep)
