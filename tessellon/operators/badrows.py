"""Rows that fail to parse, set apart with the reason, by a minimum-cost error parse.

A line is read by a small automaton over tabs, quotes and runs of other characters. Dynamic programming over
its states and columns finds the cheapest parse; its operations are, dearest first:

- ``insert`` or ``delete`` of a quote or tab inside the line: its quoting is broken;
- ``append`` of a missing column or ``drop`` of a surplus one at the end: its number of columns is wrong;
- ``reject`` of a value that its column's type does not allow.

A parse without operations loads; else the dearest kind among them states the reason. Among equally cheap
repairs the one whose fields fit their types is taken. Lines without quotes and with the right number of tabs
have one parse free of the first two kinds, so for them the JVM splits at the tabs; only the rest goes to
Python, in Arrow batches, and the lines are scanned once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellon.functions.curie import WS_CLASS, not_blank

_START, _PLAIN, _QUOTED, _CLOSED = range(4)
_NAMES = {"T": "tab", "Q": "quote"}


@dataclass(frozen=True)
class LineKind:
    """``columns``: name and check of each field; checks are curie, predicate, text, url or any."""

    name: str
    columns: tuple[tuple[str, str], ...]


SYNONYMS = LineKind("synonyms", (("curie", "curie"), ("predicate", "predicate"), ("synonym", "text")))
DRUGCHEMICAL = LineKind("drugchemical", (("subject", "curie"), ("predicate", "predicate"), ("object", "curie"), ("notes", "any"), ("url", "url")))


def _step(state: int, symbol: str) -> tuple[int, int] | None:
    """New state and how many fields further; None where the automaton stops."""
    if state == _QUOTED:
        return (_CLOSED, 0) if symbol == "Q" else (_QUOTED, 0)
    if symbol == "T":
        return _START, 1
    if state == _CLOSED:
        return (_QUOTED, 0) if symbol == "Q" else None
    if symbol == "Q":
        return (_QUOTED if state == _START else _PLAIN), 0
    return _PLAIN, 0


def symbols(line: str) -> list[tuple[str, int, str]]:
    return [({"\t": "T", '"': "Q"}.get(m.group(), "X"), m.start(), m.group()) for m in re.finditer(r'[^\t"]+|\t|"', line)]


def strict_fields(line: str) -> list[str] | None:
    """Fields of the reading without operations; None where the automaton stops or ends in a quotation."""
    if '"' not in line:
        return line.split("\t")
    state, fields, now = _START, [], []
    for kind, _, text in symbols(line):
        to = _step(state, kind)
        if to is None:
            return None
        if to[1]:
            fields.append("".join(now))
            now = []
        elif not (kind == "Q" and (state == _START or to[0] == _CLOSED)):
            now.append(text)
        state = to[0]
    return None if state == _QUOTED else [*fields, "".join(now)]


_CURIE = re.compile(f"[^:{WS_CLASS}]+:[^{WS_CLASS}]+")
_FITS = {"curie": lambda x: _CURIE.fullmatch(x) is not None, "text": lambda x: any(c.isalnum() for c in x), "url": lambda x: x == "" or re.fullmatch(r"https?://\S*", x) is not None}


class _Cell:
    """The cheapest way to a state and column: cost (inside, end, misfits, tabs), the field read so far, operations."""

    __slots__ = ("cost", "now", "path")

    def __init__(self, cost: tuple[int, int, int, int], now: tuple, path: tuple):
        self.cost, self.now, self.path = cost, now, path


def error_parse(line: str, checks: tuple[str, ...]) -> tuple[list[str] | None, str | None, list[str]]:
    """(fields, reason, operations) of the cheapest parse into as many columns as there are ``checks``; fields are null
    where there is a reason.

    Costs are explored from the least: first the one reading without operations inside the line, then the table
    of all with one at most, two, four and so on, until one reaches the end. O(symbols * columns) a table.
    """
    fields, width = strict_fields(line), len(checks)
    if fields is not None:
        more = len(fields) - width
        return (fields, None, []) if not more else (None, "column_count", ["drop column"] * more + ["append column"] * -more)
    syms, limit = symbols(line), 1
    while (operations := _repair(line, syms, checks, limit)) is None:
        limit *= 2
    return None, "quoting", operations


def _repair(line: str, syms: list[tuple[str, int, str]], checks: tuple[str, ...], limit: int) -> list[str] | None:
    """Operations of the cheapest parse with ``limit`` of them at most inside the line; None where there is no such parse.
    Surplus columns are held in one state past the last column."""
    width = len(checks)
    cells = {(_START, 0): _Cell((0, 0, 0, 0), (), ())}

    def moved(cell: _Cell, state: int, n: int, symbol: str, text: str) -> tuple[tuple[int, int], _Cell] | None:
        to = _step(state, symbol)
        if to is None:
            return None
        inside, end, misfits, tabs = cell.cost
        if not to[1]:
            mute = symbol == "Q" and (state == _START or to[0] == _CLOSED)  # an enclosing quote, or the first of two
            return (to[0], n), _Cell(cell.cost, cell.now if mute else (cell.now, text), cell.path)
        if n < width:
            misfits += not _FITS.get(checks[n], _any)(_joined(cell.now))
        surplus = n + 1 >= width
        path = (cell.path, "drop column") if surplus else cell.path
        return (to[0], min(n + 1, width)), _Cell((inside, end + surplus, misfits, tabs), (), path)

    def relax(table: dict, found: tuple[tuple[int, int], _Cell] | None) -> bool:
        if found is None or (found[0] in table and table[found[0]].cost <= found[1].cost):
            return False
        table[found[0]] = found[1]
        return True

    def edited(cell: _Cell, what: str, symbol: str, at: int) -> _Cell:
        inside, end, misfits, tabs = cell.cost
        return _Cell((inside + 1, end, misfits, tabs + (symbol == "T")), cell.now, (cell.path, f"{what} {_NAMES[symbol]} at {at}"))

    def insertions(table: dict, at: int) -> None:
        todo = [k for k, cell in table.items() if cell.cost[0] < limit]
        while todo:
            state, n = todo.pop()
            if table[state, n].cost[0] >= limit:
                continue
            for symbol, text in (("Q", '"'), ("T", "\t")):
                found = moved(edited(table[state, n], "insert", symbol, at), state, n, symbol, text)
                if relax(table, found):
                    todo.append(found[0])

    for symbol, at, text in syms:
        insertions(cells, at)
        nxt: dict = {}
        for (state, n), cell in cells.items():
            relax(nxt, moved(cell, state, n, symbol, text))
            if symbol != "X" and cell.cost[0] < limit:
                relax(nxt, ((state, n), edited(cell, "delete", symbol, at)))
        cells = nxt
    insertions(cells, len(line))
    ends = []
    for (state, n), cell in cells.items():
        if state != _QUOTED:
            missing = max(0, width - 1 - n)
            inside, end, misfits, tabs = cell.cost
            misfits += n < width and not _FITS.get(checks[n], _any)(_joined(cell.now))
            ends.append(((inside, end + missing, misfits, tabs), n, state, missing, cell))
    if not ends:
        return None
    _, _, _, missing, cell = min(ends, key=lambda e: e[:3])
    path, operations = cell.path, []
    while path:
        path, what = path
        operations.append(what)
    return operations[::-1] + ["append column"] * missing


def _any(_: str) -> bool:
    return True


def _joined(now: tuple) -> str:
    out = []
    while now:
        now, text = now
        out.append(text)
    return "".join(out[::-1])


def _valid(check: str, c: Column) -> Column:
    """Whether a field passes its check; ``_known`` is set where the predicate is allowed in the file."""
    if check == "curie":
        return c.rlike(f"^[^:{WS_CLASS}]+:[^{WS_CLASS}]+$") & ~c.contains("\n")
    if check == "predicate":
        return F.coalesce("_known", F.lit(False))
    if check == "text":
        return c.rlike(r"[\p{L}\p{N}]") & ~c.rlike(r"[\x{FFFD}\x00-\x08\x0B-\x1F\x7F-\x9F]")
    if check == "url":
        return (c == "") | (c.rlike("^https?://") & ~c.rlike(f"[{WS_CLASS}]"))
    return F.lit(True)


def parse_lines(df: DataFrame, known: DataFrame, kinds: tuple[LineKind, ...] = (SYNONYMS, DRUGCHEMICAL)) -> DataFrame:
    """``df``: line_id, filename, raw_line; ``known``: filename, predicate (a few rows of a fixed list).

    Returns line_id, kind, fields, reason (null for a valid row) and edits. Null and blank lines and lines
    that start with ``#`` are neither rows nor failures and give nothing; a file of no kind gives
    ``unknown_file``. Carriage returns at the end are dropped. Columns other than the three are ignored.
    """
    line = F.rtrim(F.col("raw_line"), F.lit("\r"))
    name = F.col("filename")
    kind = F.coalesce(*[F.when((name == k.name) | name.startswith(f"{k.name}/") | (name == f"{k.name}.tsv"), k.name) for k in kinds], F.lit(""))
    rows = df.where(not_blank("raw_line") & ~F.col("raw_line").startswith("#")).select(F.col("line_id").alias("_id"), kind.alias("_kind"), line.alias("_line"))
    width = F.coalesce(*[F.when(F.col("_kind") == k.name, F.lit(len(k.columns))) for k in kinds], F.lit(0))
    easy = ~F.col("_line").contains('"') & (F.regexp_count("_line", F.lit("\t")) + 1 == width)
    checks = {k.name: tuple(c for _, c in k.columns) for k in kinds}

    @F.udf("struct<fields: array<string>, reason: string, edits: array<string>>", useArrow=True)
    def parse(kind: str | None, line: str | None):
        return None if line is None else error_parse(line, checks[kind])

    hard = ~F.col("_easy") & (F.col("_kind") != "")
    rows = rows.withColumn("_easy", easy)
    rows = rows.withColumn("_hard", parse(F.when(hard, F.col("_kind")), F.when(hard, F.col("_line"))))
    fields = F.when(F.col("_easy"), F.split("_line", "\t", -1)).otherwise(F.col("_hard.fields"))
    reason = F.when(F.col("_kind") == "", "unknown_file").otherwise(F.col("_hard.reason"))
    rows = rows.select("_id", "_kind", fields.alias("_fields"), reason.alias("reason"), F.coalesce("_hard.edits", F.array().cast("array<string>")).alias("edits"))
    place = {k.name: next((i for i, (_, c) in enumerate(k.columns) if c == "predicate"), None) for k in kinds}
    predicate = F.coalesce(*[F.when(F.col("_kind") == n, F.get("_fields", F.lit(i))) for n, i in place.items() if i is not None], F.lit(None).cast("string"))
    allowed = known.select(F.col("filename").alias("_kind"), F.col("predicate").alias("_predicate")).distinct().withColumn("_known", F.lit(True))
    checked = rows.withColumn("_predicate", predicate).join(allowed, ["_kind", "_predicate"], "left")
    misfits = [F.when((F.col("_kind") == k.name) & ~_valid(c, F.get("_fields", F.lit(i))), F.lit(f"reject {n}")) for k in kinds for i, (n, c) in enumerate(k.columns)]
    checked = checked.withColumn("_rejected", F.when(F.col("_fields").isNotNull(), F.array_compact(F.array(*misfits))).otherwise(F.array().cast("array<string>")))
    reason = F.coalesce("reason", F.when(F.size("_rejected") > 0, "invalid_value"))
    return checked.select(F.col("_id").alias("line_id"), F.col("_kind").alias("kind"), F.col("_fields").alias("fields"), reason.alias("reason"), F.concat("edits", "_rejected").alias("edits"))


def valid_rows(parsed: DataFrame, kind: LineKind) -> DataFrame:
    """The rows of one kind that load, a column per field."""
    return parsed.where((F.col("kind") == kind.name) & F.col("reason").isNull()).select("line_id", *[F.get("fields", F.lit(i)).alias(n) for i, (n, _) in enumerate(kind.columns)])


def failed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("line_id", "reason", "edits")


