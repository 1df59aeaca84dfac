import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cropmill.functions import grid


STOCK = "<fcel>Item<fcel>May<lcel><nl><ucel><fcel>in<fcel>out<nl><fcel>Tea<fcel>40<ecel><nl>"
STOCK_HTML = '<table><tbody><tr><td rowspan="2">Item</td><td colspan="2">May</td></tr><tr><td>in</td><td>out</td></tr><tr><td>Tea</td><td>40</td><td></td></tr></tbody></table>'


def test_both_notations_of_a_stock_list():
    g = grid.parse(STOCK)
    assert (g.rows, g.columns, len(g.cells)) == (3, 3, 7) and sum(c.rowspan * c.colspan for c in g.cells) == 9
    assert grid.to_html(g) == STOCK_HTML and grid.parse(STOCK_HTML) == g and grid.to_otsl(g) == STOCK
    assert grid.parse(STOCK.removesuffix(grid.NEWLINE)) == g


def test_text_of_cells_survives_both_notations():
    g = grid.parse_html("<table><tr><td> 5 &lt; 7 &amp; 9 <br>next  line</td><td>&nbsp;</td></tr></table>")
    assert [c.text for c in g.cells] == ["5 < 7 & 9 \nnext  line", ""]
    assert grid.parse(grid.to_html(g)) == g and grid.parse(grid.to_otsl(g)) == g


@pytest.mark.parametrize("row", range(3))
@pytest.mark.parametrize("col", range(3))
def test_a_token_out_of_place_has_no_grid(row, col):
    """In a grid of plain cells every span token at the border, and every token missing or added, is an error."""
    def table(change):
        rows = [[f"<fcel>{r}{c}" for c in range(3)] for r in range(3)]
        change(rows[row])
        return "".join("".join(r) + "<nl>" for r in rows)

    def put(token):
        return lambda line: line.__setitem__(col, token)

    bad = [lambda line: line.pop(col), lambda line: line.insert(col, "<ecel>"), put("<xcel>"), put("<ecel>words"), put("<lcel>words"), lambda line: line.clear()]
    bad += [put("<lcel>")] * (col == 0) + [put("<ucel>")] * (row == 0)
    for change in bad:
        with pytest.raises(grid.GridError):
            grid.parse_otsl(table(change))
    for change in [put("<lcel>")] * (col > 0) + [put("<ucel>")] * (row > 0):
        assert len(grid.parse_otsl(table(change)).cells) == 8


@pytest.mark.parametrize("bad", ["", "words alone", "words <fcel>x<nl>", "<nl><fcel>x<nl>", "<fcel>p<lcel><nl><ucel><ecel><nl>", "<fcel>p<fcel>q<nl><lcel><ucel><nl>"])
def test_strings_that_are_no_otsl(bad):
    with pytest.raises(grid.GridError):
        grid.parse_otsl(bad)


def page(*rows):
    return "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"


@pytest.mark.parametrize(
    "bad",
    [
        None, "no element", "<table>", page(), page(""), page("<td>1</td><td>2</td>", "<td>3</td>"), page("<td>1</td>", "<td rowspan=3>2</td>"), page("<td colspan=0>1</td>"), page("<td rowspan=two>1</td>"),
        page("<td colspan=10001>1</td>"), page("<td>1</td><td rowspan=2>2</td>", "<td colspan=2>3</td>"), page("<td>1</td>") * 2, page(f"<td>{page('<td>1</td>')}</td>"), page("<td><img src=x></td>"), page("<td><style>a</style></td>"),
    ],
)
def test_pages_that_have_no_grid(bad):
    with pytest.raises(grid.GridError):
        grid.parse_html(bad)


@pytest.mark.parametrize("token", [grid.FULL, grid.EMPTY, grid.LEFT, grid.UP, grid.CROSS, grid.NEWLINE])
def test_text_that_reads_like_a_token(token):
    g = grid.parse_html(page(f"<td>see {token.replace('<', '&lt;')}</td>"))
    assert g.cells[0].text == f"see {token}"
    with pytest.raises(grid.GridError):
        grid.to_otsl(g)


def test_sections_and_implied_ends():
    g = grid.parse_html("<table><thead><tr><th>a<th>b</thead><tbody><tr><td>1<td>2</tbody></table>")
    assert [c.text for c in g.cells] == ["a", "b", "1", "2"]


def test_similarity_of_a_harvest_table():
    """Seven elements: a body, two rows, four cells. Changes are counted in elements by hand."""
    harvest = page("<td>oats</td><td>31</td>", "<td>rye</td><td>7</td>")
    other = {
        page("<td>oats</td><td>31</td>", "<td>rie</td><td>7</td>"): 1 / 3,  # one of three letters
        page("<td>oats</td><td>31</td>"): 3,  # a row and its cells are gone
        page("<td>oats</td><td>31</td>", "<td>rye</td><td>7</td>", "<td>hay</td><td>2</td>"): 3,
        page("<td>31</td><td>oats</td>", "<td>rye</td><td>7</td>"): 2,  # both cells are written anew
    }
    g = grid.parse(harvest)
    for html, changes in other.items():
        x = grid.parse(html)
        assert grid.teds(x, g) == grid.teds(g, x) == pytest.approx(1 - changes / max(7, 1 + 3 * x.rows))
    plain = grid.parse(page("<td>x</td><td>x</td>", "<td>x</td><td>x</td>"))
    assert grid.teds(g, g) == grid.teds(plain, g, structure_only=True) == 1


def _distance(a, b):
    """Tree edit distance by the plain recursion on forests."""
    from functools import lru_cache

    def tree(g):
        rows = [[] for _ in range(g.rows)]
        for c in sorted(g.cells):
            rows[c.row].append((("td", c.colspan, c.rowspan, tuple(c.text)), ()))
        return (("table", 1, 1, ()), ((("tbody", 1, 1, ()), tuple((("tr", 1, 1, ()), tuple(r)) for r in rows)),))

    @lru_cache(None)
    def go(x, y):
        if not x and not y:
            return 0
        if not x:
            return go((), y[:-1] + y[-1][1]) + 1
        if not y:
            return go(x[:-1] + x[-1][1], ()) + 1
        return min(go(x[:-1] + x[-1][1], y) + 1, go(x, y[:-1] + y[-1][1]) + 1, go(x[:-1], y[:-1]) + go(x[-1][1], y[-1][1]) + grid._rename(x[-1][0], y[-1][0]))

    return go((tree(a),), (tree(b),))


tables = st.lists(st.lists(st.text("ab", max_size=2), min_size=2, max_size=2), min_size=1, max_size=3).map(lambda rows: grid.parse("<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"))


@settings(max_examples=40, deadline=None)
@given(tables, tables)
def test_tree_distance_is_the_optimum(a, b):
    assert grid.tree_distance(grid._tree(a, False), grid._tree(b, False)) == pytest.approx(_distance(a, b))


def test_compare_statuses():
    ok = "<fcel>a<nl>"
    assert grid.compare_tables("bad", ok)["status"] == "invalid_prediction" and grid.compare_tables("bad", ok)["score"] == 0
    assert grid.compare_tables(ok, "bad")["status"] == "invalid_gt"
    q = grid.compare_tables("<table><tr><td>a</td></tr></table>", ok)
    assert q["exact"] and q["score"] == 1 and q["cell_text_ned"] == 0
