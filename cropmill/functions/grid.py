"""Tables as HTML and as OTSL: parsing into a grid, canonical forms, features and tree similarity.

The grid is strict: what would have to be guessed (ragged rows, overlapping or orphaned spans) is an error. The Python
functions run inside Arrow UDFs; the columns they give are structs with an error instead of an exception.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache
from html import escape
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cropmill.functions.text import edit_distance

#: The tokens of OTSL.
FULL, EMPTY, LEFT, UP, CROSS, NEWLINE = "<fcel>", "<ecel>", "<lcel>", "<ucel>", "<xcel>", "<nl>"
TOKEN = re.compile(r"<(?:fcel|ecel|lcel|ucel|xcel|nl)>")
#: Elements a table must not hold, the largest span, and the largest grid.
ACTIVE = re.compile(r"<\s*(?:script|style|iframe|img)\b", re.I)
MOST_SPAN, MOST_SLOTS = 10_000, 1_000_000
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: What a start tag closes when it is still open, up to the nearest table.
_CLOSES = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "thead", "tbody", "tfoot"}}
_CLOSES |= {"thead": _CLOSES["tbody"], "tfoot": _CLOSES["tbody"]}


class GridError(ValueError):
    """A table that has no grid."""


class Cell(NamedTuple):
    row: int
    col: int
    rowspan: int
    colspan: int
    text: str


class Grid(NamedTuple):
    cells: tuple[Cell, ...]
    rows: int
    columns: int


class _Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs, self.parts = tag, attrs, []

    def nodes(self) -> list[_Node]:
        return [p for p in self.parts if isinstance(p, _Node)]

    def all(self) -> Iterable[_Node]:
        for n in self.nodes():
            yield n
            yield from n.all()

    def text(self) -> str:
        return "".join(p if isinstance(p, str) else "\n" if p.tag == "br" else p.text() for p in self.parts)


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [_Node("#root", {})]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        shut = _CLOSES.get(tag, ())
        while self.open[-1].tag in shut:
            self.open.pop()
        node = _Node(tag, dict(attrs))
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag == "table":
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def _span(node: _Node, name: str) -> int:
    try:
        n = int(node.attrs.get(name) or "1")
    except ValueError:
        raise GridError("span is not a number") from None
    if not 1 <= n <= MOST_SPAN:
        raise GridError("span out of bounds")
    return n


def parse_html(value: str | None) -> Grid:
    """The grid of the one table in an HTML fragment."""
    if not isinstance(value, str) or "<table" not in value.lower():
        raise GridError("no table element")
    if ACTIVE.search(value):
        raise GridError("active or non-text element")
    reader = _Reader()
    reader.feed(value)
    reader.close()
    tables = [n for n in reader.open[0].all() if n.tag == "table"]
    if len(tables) != 1:
        raise GridError("not exactly one table")
    lines = [x for n in tables[0].nodes() for x in ([n] if n.tag == "tr" else n.nodes() if n.tag in ("thead", "tbody", "tfoot") else ()) if x.tag == "tr"]
    if not lines:
        raise GridError("no rows")
    taken: set[tuple[int, int]] = set()
    cells = []
    for r, line in enumerate(lines):
        c = 0
        for node in line.nodes():
            if node.tag not in ("td", "th"):
                continue
            while (r, c) in taken:
                c += 1
            down, right = _span(node, "rowspan"), _span(node, "colspan")
            if r + down > len(lines):
                raise GridError("span out of bounds")
            if len(taken) + down * right > MOST_SLOTS:
                raise GridError("grid too large")
            area = {(y, x) for y in range(r, r + down) for x in range(c, c + right)}
            if area & taken:
                raise GridError("overlapping spans")
            taken |= area
            cells.append(Cell(r, c, down, right, node.text().strip()))
            c += right
    if not taken:
        raise GridError("no cells")
    width = 1 + max(x for _, x in taken)
    if len(taken) != width * len(lines):
        raise GridError("ragged grid")
    return Grid(tuple(cells), len(lines), width)


def parse_otsl(value: str) -> Grid:
    """The grid of an OTSL string; the last newline token may be missing."""
    if not isinstance(value, str):
        raise GridError("no OTSL")
    value = value.strip()
    marks = list(TOKEN.finditer(value))
    if not marks or marks[0].start() > 0:
        raise GridError("OTSL must start with a token")
    lines: list[list[tuple[str, str]]] = [[]]
    for mark, after in zip(marks, [*marks[1:], None]):
        text = value[mark.end() : after.start() if after else len(value)].strip()
        if text and mark[0] != FULL:
            raise GridError("text outside a full cell")
        if mark[0] != NEWLINE:
            lines[-1].append((mark[0], text))
        elif not lines[-1]:
            raise GridError("empty row")
        else:
            lines.append([])
    if not lines[-1]:
        lines.pop()
    if not lines or any(len(x) != len(lines[0]) for x in lines):
        raise GridError("ragged grid")
    owner: dict[tuple[int, int], tuple[int, int]] = {}
    area: dict[tuple[int, int], list[int]] = {}  # of each cell: slots, last row, last column
    for r, line in enumerate(lines):
        for c, (token, _) in enumerate(line):
            beside, above = owner.get((r, c - 1)), owner.get((r - 1, c))
            if token in (FULL, EMPTY):
                own = (r, c)
            elif token == LEFT and beside and beside[0] == r:
                own = beside
            elif token == UP and above and above[1] == c:
                own = above
            elif token == CROSS and above and above == beside and above[0] < r and above[1] < c:
                own = above
            else:
                raise GridError("orphaned span token")
            owner[r, c] = own
            a = area.setdefault(own, [0, r, c])
            a[:] = a[0] + 1, max(a[1], r), max(a[2], c)
    cells = []
    for (r, c), (n, last_row, last_col) in area.items():
        down, right = last_row - r + 1, last_col - c + 1
        if n != down * right:
            raise GridError("merged cell is no rectangle")
        cells.append(Cell(r, c, down, right, lines[r][c][1]))
    return Grid(tuple(cells), len(lines), len(lines[0]))


def parse(value: str) -> Grid:
    """HTML or OTSL, as the first token says."""
    return parse_otsl(value) if isinstance(value, str) and TOKEN.match(value.strip()) else parse_html(value)


def to_html(grid: Grid) -> str:
    """The canonical HTML of a grid."""
    rows: list[list[str]] = [[] for _ in range(grid.rows)]
    for cell in sorted(grid.cells):
        spans = "".join(f' {name}="{n}"' for name, n in (("rowspan", cell.rowspan), ("colspan", cell.colspan)) if n > 1)
        rows[cell.row].append(f"<td{spans}>{escape(cell.text, quote=False).replace(chr(10), '<br/>')}</td>")
    return "<table><tbody>" + "".join(f"<tr>{''.join(r)}</tr>" for r in rows) + "</tbody></table>"


def to_otsl(grid: Grid) -> str:
    """The OTSL of a grid; an error where a text holds a token."""
    slots = [[""] * grid.columns for _ in range(grid.rows)]
    for cell in grid.cells:
        if TOKEN.search(cell.text):
            raise GridError("OTSL token in a text")
        for r in range(cell.rowspan):
            for c in range(cell.colspan):
                mark = CROSS if r and c else UP if r else LEFT if c else FULL + cell.text if cell.text else EMPTY
                slots[cell.row + r][cell.col + c] = mark
    return "".join("".join(row) + NEWLINE for row in slots)


def canonical(value: str) -> str:
    return to_html(parse(value))


class _Tree(NamedTuple):
    labels: list[tuple]  # in postorder: (tag, colspan, rowspan, content)
    leftmost: list[int]
    keyroots: list[int]
    elements: int


def _tree(grid: Grid, structure_only: bool) -> _Tree:
    labels, leftmost, breaks = [], [], 0
    by_row: list[list[Cell]] = [[] for _ in range(grid.rows)]
    for cell in sorted(grid.cells):
        by_row[cell.row].append(cell)
    for row in by_row:
        first = len(labels)
        for cell in row:
            breaks += cell.text.count("\n")
            content = () if structure_only else tuple(x for ch in cell.text for x in (("<br>", "</br>") if ch == "\n" else (ch,)))
            leftmost.append(len(labels))
            labels.append(("td", cell.colspan, cell.rowspan, content))
        leftmost.append(first)
        labels.append(("tr", 1, 1, ()))
    for tag in ("tbody", "table"):
        leftmost.append(0)
        labels.append((tag, 1, 1, ()))
    keyroots = sorted({left: i for i, left in enumerate(leftmost)}.values())
    return _Tree(labels, leftmost, keyroots, len(labels) - 1 + breaks)


def _rename(a: tuple, b: tuple) -> float:
    if a[:3] != b[:3]:
        return 1.0
    return 0.0 if a[3] == b[3] else edit_distance(a[3], b[3]) / max(len(a[3]), len(b[3]))


def _renames(a: _Tree, b: _Tree) -> list[list[float]]:
    """The cost of renaming each node of a to each of b; nodes alike are compared once."""
    mine, theirs = list(dict.fromkeys(a.labels)), list(dict.fromkeys(b.labels))
    at = {y: k for k, y in enumerate(theirs)}
    columns = [at[y] for y in b.labels]
    rows = {x: [_rename(x, y) for y in theirs] for x in mine}
    spread = {x: [costs[k] for k in columns] for x, costs in rows.items()}
    return [spread[x] for x in a.labels]


def tree_distance(a: _Tree, b: _Tree) -> float:
    """Ordered tree edit distance by the forests of all pairs of keyroots; insertions and deletions cost 1."""
    if a.labels == b.labels and a.leftmost == b.leftmost:
        return 0.0
    rename = _renames(a, b)
    done = [[0.0] * len(b.labels) for _ in a.labels]
    for i in a.keyroots:
        li = a.leftmost[i]
        for j in b.keyroots:
            lj = b.leftmost[j]
            f = [[float(y) for y in range(j - lj + 2)]]
            for p in range(li, i + 1):
                up, row, whole, costs = f[-1], [f[-1][0] + 1], a.leftmost[p] == li, rename[p]
                back, inner = f[a.leftmost[p] - li], done[p]
                for y, q in enumerate(range(lj, j + 1), 1):
                    best = up[y] if up[y] < row[y - 1] else row[y - 1]
                    best += 1
                    if whole and b.leftmost[q] == lj:
                        other = up[y - 1] + costs[q]
                        if other < best:
                            best = other
                        inner[q] = best
                    else:
                        other = back[b.leftmost[q] - lj] + inner[q]
                        if other < best:
                            best = other
                    row.append(best)
                f.append(row)
    return done[-1][-1]


def teds(pred: Grid, gt: Grid, structure_only: bool = False) -> float:
    return _similarity(_tree(pred, structure_only), _tree(gt, structure_only))


QUALITY = "score double, status string, metric string, teds_s double, cell_text_ned double, ned double, exact boolean, cer double, wer double, render_status string, error string"


class _Table(NamedTuple):
    """A table as it is compared: its trees with and without content, the text of its cells, its canonical form."""

    content: _Tree
    structure: _Tree
    text: str
    html: str


@lru_cache(256)
def _table(value: str | None) -> _Table | str:
    """The table, or why there is none. The tables of a row are compared several times; so few are kept that rows bound the memory."""
    try:
        g = parse(value)
    except GridError as e:
        return str(e)
    return _Table(_tree(g, False), _tree(g, True), "\n".join(c.text for c in sorted(g.cells)), to_html(g))


def _similarity(a: _Tree, b: _Tree) -> float:
    return max(0.0, min(1.0, 1 - tree_distance(a, b) / max(a.elements, b.elements, 1)))


def compare_tables(pred: str | None, gt: str | None) -> dict:
    """Quality of a predicted table against the true one."""
    g = _table(gt)
    if isinstance(g, str):
        return {"status": "invalid_gt", "error": g}
    p = _table(pred)
    if isinstance(p, str):
        return {"score": 0.0, "status": "invalid_prediction", "metric": "teds", "error": p}
    if p.html == g.html:
        return {"score": 1.0, "status": "ok", "metric": "teds", "teds_s": 1.0, "cell_text_ned": 0.0, "exact": True}
    score = _similarity(p.content, g.content)
    shape = _similarity(p.structure, g.structure)
    ned = edit_distance(p.text, g.text) / max(len(p.text), len(g.text), 1)
    return {"score": score, "status": "ok", "metric": "teds", "teds_s": shape, "cell_text_ned": ned, "exact": False}


_NAMES = [x.split()[0] for x in QUALITY.split(", ")]


def _compare_arrays(pred: pd.Series, gt: pd.Series) -> pd.Series:
    """Arrays of predictions and of gts -> arrays of qualities; equal comparisons of a batch are made once."""
    seen: dict[tuple, dict] = {}

    def one(p, g):
        if p is None or g is None:
            return None
        if (p, g) not in seen:
            q = compare_tables(p, g)
            seen[p, g] = {k: q.get(k) for k in _NAMES}
        return seen[p, g]

    return pd.Series([None if ps is None else [one(p, g) for p, g in zip(ps, gs)] for ps, gs in zip(pred, gt)])


def compare_table_arrays(pred: Column, gt: Column) -> Column:
    # Nondeterministic, so that no filter on what follows computes it again.
    return F.pandas_udf(_compare_arrays, f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in QUALITY.split(', ')).replace(', ', ',')}>>").asNondeterministic()(pred, gt)


GRID = "canonical string, otsl string, is_otsl boolean, rows int, columns int, cells int, merged_cells int, error string"


def describe(value: str | None) -> dict:
    """The canonical forms and features of a table, or why it has none."""
    out: dict = {k.split()[0]: None for k in GRID.split(", ")}
    if value is None:
        return out
    out["is_otsl"] = False
    try:
        grid = parse(value)
    except GridError as e:
        return out | {"error": str(e)}
    html = to_html(grid)
    out |= {"canonical": html, "is_otsl": bool(TOKEN.match(value.strip())), "rows": grid.rows, "columns": grid.columns, "cells": len(grid.cells), "merged_cells": sum(c.rowspan > 1 or c.colspan > 1 for c in grid.cells)}
    try:
        out["otsl"] = to_otsl(grid)
    except GridError as e:
        out["error"] = str(e)
    return out


def _describe(s: pd.Series) -> pd.DataFrame:
    seen = {v: describe(v) for v in s.dropna().unique()}
    return pd.DataFrame([seen.get(v) or describe(None) for v in s], columns=[x.split()[0] for x in GRID.split(", ")]).astype({k: "Int32" for k in ("rows", "columns", "cells", "merged_cells")})


def describe_column(c: Column) -> Column:
    """Struct GRID of a column of tables."""
    return F.pandas_udf(_describe, GRID)(c)


def _describe_arrays(s: pd.Series) -> pd.Series:
    seen: dict = {}

    def one(v):
        if v not in seen:
            d = describe(v)
            seen[v] = {"canonical": d["canonical"], "is_otsl": d["is_otsl"] or False}
        return seen[v]

    return s.map(lambda vs: [one(v) for v in vs], na_action="ignore")


def describe_array(c: Column) -> Column:
    """Array of structs (canonical, is_otsl) of an array of tables."""
    return F.pandas_udf(_describe_arrays, "array<struct<canonical:string,is_otsl:boolean>>")(c)
