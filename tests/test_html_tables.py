"""Tables read by the tokenizer, against tables that are drawn up first and then written as loose HTML."""

import random

import pytest

from quipu.sources.html_tables import MOST_FILLED, page_tables, tables_of

RNG = random.Random(9)
NOISE = ["<!-- <td>no</td> </table> -->", "<script>var a = '</td><td></table>';</script>", "<style>td{}</style>", "<br>", "<b>", "</b>", "</i>", "<p>", "<tbody>", "</thead>", "\n\t "]


def drawn(depth=0):
    """A table as rows of cells: (text, columns, rows, header, table within or None)."""
    rows = []
    for _ in range(RNG.randint(0, 4)):
        cell = lambda: ("".join(RNG.choice("ab &<ñ") for _ in range(RNG.randint(0, 5))), RNG.choice([1, 1, 2, 3]), RNG.choice([1, 1, 2]), RNG.random() < 0.2, drawn(depth + 1) if depth < 2 and RNG.random() < 0.2 else None)
        rows.append([cell() for _ in range(RNG.randint(0, 4))])
    return rows


def written(rows, ends=True):
    noise = lambda: RNG.choice(NOISE) if RNG.random() < 0.3 else ""
    case = lambda tag: RNG.choice([tag, tag.upper()])
    out = f"<{case('table')} class='x'>{noise()}"
    for row in rows:
        out += f"<{case('tr')}>{noise()}"
        for text, columns, spans, header, inner in row:
            tag = "th" if header else "td"
            shown = "".join({"&": RNG.choice(["&amp;", "&#38;"]), "<": "&lt;", "ñ": RNG.choice(["&ntilde;", "ñ"])}.get(c, c) for c in text)
            out += f"<{case(tag)}{f' colspan={columns}' if columns > 1 else ''}{f' ROWSPAN=\"{spans}\"' if spans > 1 else ''}>{noise()}{shown}{noise()}"
            if inner is not None:
                out += written(inner)
            out += f"</{tag}>" if RNG.random() < 0.6 else ""
        out += "</tr>" if RNG.random() < 0.6 else ""
    return out + (f"{noise()}</{case('table')}>" if ends else "")


def wanted(rows, numbers, parent=None):
    """The grids of a table and of those within, by filling a dictionary of places."""
    mine, places, found = next(numbers), {}, []
    for y, row in enumerate(rows):
        x = 0
        for text, columns, spans, _, inner in row:
            while (y, x) in places:
                x += 1
            for dx in range(columns):
                for dy in range(min(spans, len(rows) - y)):
                    places[y + dy, x + dx] = " ".join(text.split())
            x += columns
            if inner is not None:
                found += wanted(inner, numbers, mine)
    grid = [([places.get((y, x), "") for x in range(1 + max((c for r, c in places if r == y), default=-1))], bool(row) and all(c[3] for c in row)) for y, row in enumerate(rows)]
    return [(mine, parent, grid), *found]


def test_random_tables():
    for k in range(400):
        tables = [drawn() for _ in range(RNG.randint(1, 3))]
        html = "<html><p>before" + "between".join(written(t, ends=k % 3 > 0 or i < len(tables) - 1) for i, t in enumerate(tables))
        numbers = iter(range(1000))
        want = sorted((x for t in tables for x in wanted(t, numbers)), key=lambda x: x[0])
        assert tables_of(html) == want, html


@pytest.mark.parametrize("html,cells", [
    ("<table><tr><td>a<td>b<tr><td>c", [["a", "b"], ["c"]]),
    ("<table><td>no row</table>", [["no row"]]),
    ("<table><tr><td>x <table><tr><td>in</table> y</td></tr></table>", [["x y"], ["in"]]),
    ("<table><tr><td rowspan=0>a<td>1<tr><td>2<tr><td>3</table>", [["a", "1"], ["a", "2"], ["a", "3"]]),
    ("<table><tr><td colspan=x>a<td colspan=0>b<td colspan=-2>c</table>", [["a", "b", "c", "c"]]),
    ("<td>no table</td><tr></table>", []),
    ("<table><tr><td>&nbsp;a&#8364;&unknown;</td>", [["a€&unknown;"]]),
    ("<table><tr><td>a</td>text between<td>b</td></table>", [["a", "b"]]),
    ("<table><tr><td>a<textarea><td>b</textarea>c", [["a c"]]),
    ("", []), (None, []),
])
def test_loose_pages(html, cells):
    assert [c for _, _, grid in tables_of(html) for c, _ in grid] == cells


def test_spans_are_bounded():
    html = "<table>" + "<tr><td colspan=1000 rowspan=65534>x" * 3000
    assert sum(len(c) for _, _, grid in tables_of(html) for c, _ in grid) <= MOST_FILLED + 3000 + 1000
    deep = "<table><tr><td>" * 3000
    assert len(tables_of(deep)) == 3000


def test_pages_as_a_table(spark):
    rows = [(2**53 + 1, "<table><tr><th>h<tr><td>1"), (None, "<table><tr><td>n"), (7, None), (7, "no"), (8, "<table></table>"), (2**53 + 1, "<table><tr><td>again")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, cells string").repartition(1)
    got = sorted(map(str, page_tables(df).collect()))
    from pyspark.sql import Row

    row = lambda k, n, h, cells: str(Row(page_id=k, table_no=0, parent_no=None, row_no=n, header=h, cells=cells))
    assert got == sorted([row(2**53 + 1, 0, True, ["h"]), row(2**53 + 1, 1, False, ["1"]), row(None, 0, False, ["n"]), row(2**53 + 1, 0, False, ["again"])])
    assert page_tables(df.filter("spark_partition_id() < 0")).count() == 0
