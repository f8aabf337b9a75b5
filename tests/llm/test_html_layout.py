"""Layout of tables and lists, odd attributes and deep nesting."""

import random
import time

import pytest

from tremorlake.llm import html_render
from tremorlake.llm.html_render import render


def test_row_spans_are_carried_down():
    assert render("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>") == "A  B\n   C"
    assert render("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>") == "a  b  c\nd     e\nf     g"
    assert render("<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>1<td>2<td>3</table>") == "ab     c\n       d\n1   2  3"
    assert render("<table><tr><td rowspan=3>x<td>y<tr><tr><td>z<tr><td>w</table>") == "x  y\n   z\nw"


def test_columns_stay_in_line_beside_wide_cells():
    long = " ".join(f"word{i}" for i in range(60))
    lines = render(f"<table><tr><td>{long}<td>right<tr><td>short<td>below</table>").split("\n")
    at = lines[0].index("right")
    assert lines[-1].index("below") == at and " ".join(" ".join(lines[:-1]).replace("right", "").split()) == long
    assert max(len(line) for line in lines) <= at + len("right") and at <= html_render.WIDEST + 2
    assert render(f"<table><tr><td>a<td>{long}</table>") == f"a  {long}"  # nothing stands behind it
    word = "x" * 200
    assert render(f"<table><tr><td>{word}<td>b<tr><td>c<td>d</table>") == f"{word}  b\n" + "c".ljust(82) + "d"


def _placed_by_hand(rows):
    """Grid of the cell texts that begin in each column, as the standard's table model places them."""
    taken, grid = set(), []
    for y, row in enumerate(rows):
        x, begins = 0, {}
        for text, across, down in row:
            while (x, y) in taken:
                x += 1
            begins[x] = text
            taken |= {(x + i, y + j) for i in range(across) for j in range(down)}
        grid.append(begins)
    return grid


@pytest.mark.parametrize("seed", range(30))
def test_cells_of_a_column_begin_in_one_place(seed):
    """Against a second, simple layout: a grid of places."""
    rng = random.Random(seed)
    rows = [[(f"r{y}c{k}" + "x" * rng.randrange(6), rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 1, 2, 3]))
             for k in range(rng.randint(1, 5))] for y in range(rng.randint(1, 6))]
    html = "".join("<tr>" + "".join(f"<td colspan={a} rowspan='{d}'>{t}" for t, a, d in row) for row in rows)
    lines = render(f"<table>{html}</table>").split("\n")
    grid = _placed_by_hand(rows)
    columns = sorted({x for begins in grid for x in begins})
    begin, at = {}, 0
    for x in columns:
        begin[x] = at
        at += max(len(b[x]) for b in grid if x in b) + 2
    want = []
    for begins in grid:
        line = ""
        for x in sorted(begins):
            line = line.ljust(begin[x]) + begins[x]
        want.append(line)
    assert lines == want


@pytest.mark.parametrize("value", ["--5", "-", "", "x", "9" * 5000, "-" + "9" * 5000, "1.5", "²", "٣", " 7 ", "+3", "1e9", "0", "-1", "\x00"])
def test_odd_numbers(value):
    assert [w for w in render(f'<ol start="{value}"><li>a<li>b</ol>').split() if w in "ab"] == ["a", "b"]
    assert render(f'<table><tr><td colspan="{value}" rowspan="{value}">a<td>b<tr><td>c</table>').split() == ["a", "b", "c"]


def test_numbers_of_lists():
    assert render("<ol start='-2'><li>a<li>b</ol>") == "-2. a\n-1. b"
    assert render("<ol start=' 7px'><li>a</ol>") == "7. a"


DEEP = {
    "div": lambda n: "<div>" * n + "z", "p in button": lambda n: "<p><button>" + "<div>" * n + "z",
    "b": lambda n: "<b>" * n + "z" + "</i>" * n, "ul": lambda n: "<ul><li>a" * (n // 2), "table": lambda n: "<table><tr><td>a" * (n // 3),
    "ends": lambda n: "<div><i>" * (n // 2) + "</b>" * n, "li": lambda n: "<ul>" + "<li><div>a" * (n // 2),
    "svg": lambda n: "<svg>" + "<g>" * n + "<text>z", "blockquote": lambda n: "<blockquote>a" * n, "dl": lambda n: "<dl><dd>a" * (n // 2),
    "spans": lambda n: "<table>" + "<tr><td colspan=1000 rowspan=2>a" * (n // 20) + "</table>",
}


@pytest.mark.parametrize("name", DEEP)
def test_time_grows_with_the_page(name):
    def seconds(n):
        start = time.perf_counter()
        text = render(DEEP[name](n))
        assert text.count("a") + text.count("z") == DEEP[name](n).split("</table>")[0].count(">a") + DEEP[name](n).count(">z")
        return time.perf_counter() - start

    seconds(2000)
    short, long = seconds(10_000), seconds(100_000)
    assert long < 40 * max(short, 0.02) and long < 30
