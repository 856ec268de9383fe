"""Equivalence classes, templates and slots of hosts with several pages."""

from __future__ import annotations

import pytest

from tallymark.llm import pages

SCHEMA = "page_id long, url string, html string"
WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll lagoon meadow notch orchard prairie".split()


def prose(i: int, n: int = 40) -> str:
    """Sentences that no other page has."""
    return " ".join(WORDS[(i * 7 + k * (i + 3) + k * k) % len(WORDS)] + str(i * 100 + k) for k in range(n)) + "."


def page(body: str) -> str:
    return f"<html><head><title>Some page</title></head><body>{body}</body></html>"


def hosts() -> tuple[list[tuple], dict[int, str]]:
    rows, wanted = [], {}

    def add(host: str, i: int, body: str, text: list[str]) -> None:
        wanted[len(rows)] = "\n".join(text)
        rows.append((len(rows), f"http://{host}.example/{i}", page(body)))

    for i in range(8):
        a, b = prose(i), prose(i + 50)
        # title in an element named like a header, advert and notice with numbers in unnamed boxes
        add("boxes", i, f"""<div class=top><a href=/>Home</a> <a href=/n>News</a></div><div class=post-header><h1>Title {i}</h1></div>
            <div class=box>Buy the new phone {i} now!</div><div class=story><p>{a}</p><p>{b}</p></div>
            <div class=notes-x>Our offices close at {i} today</div>""", [f"Title {i}", a, b])
        # the article in two sibling slots of one name each page
        add("siblings", i, f"<div><a href=/>Home</a></div><div><h1>On {i}</h1><p>{a}</p></div><div><p>{b}</p></div><div><p>Write to us</p></div>",
            [f"On {i}", a, b])
        # one text on every page, in changing order with the containers: no template text
        note = "<p>Please read all of this with some care</p>"
        said = "Please read all of this with some care"
        first = i % 2
        add("order", i, f"<div class=one>{note * first}<p>{a}</p></div><div class=two>{note * (1 - first)}<p>{b}</p></div>",
            [said, a, b] if first else [a, said, b])
        # one text on three of four pages, in changing gaps of the containers: no template text
        has = i % 4 < 3
        here = has and i < 4
        there = has and i >= 4
        add("nesting", i, f"<div class=one>{note * here}<p>{a}</p></div><div class=two>{note * there}<p>{b}</p></div>",
            [*[said] * here, a, *[said] * there, b])
        # the same text in one place on three of four pages is
        add("fixed", i, f"<div class=one><p>{a}</p></div><div class=two>{note * has}<p>{b}</p></div>", [a, b])
        # copies of one article are no template
        add("copies", i, f"<div class=one><h1>Same</h1><p>{prose(99)}</p></div><div class=menu>{i}</div>", ["Same", prose(99)])
    for n in (2, 3, 4):
        for i in range(n):
            a = prose(i + 10 * n)
            add(f"small{n}", i, f"<div class=hint>All texts are free to read</div><div class=text><h1>No {i}</h1><p>{a}</p></div><div class=end>Until soon</div>",
                [f"No {i}", a])
    return rows, wanted


@pytest.mark.parametrize("held", [100_000, 0])
def test_slots_of_templates(spark, monkeypatch, held):
    monkeypatch.setattr(pages, "HELD_ROWS", held)
    rows, wanted = hosts()
    got = {r.page_id: r.text for r in pages.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, url, _ in rows:
        assert (url, got[k]) == (url, wanted[k])


def test_order_and_gaps_of_classes(spark):
    rows, _ = hosts()
    frame = spark.createDataFrame(rows, SCHEMA)
    said = pages._hash("text:Please read all of this with some care")
    found = {r.host.split(".")[0]: r for r in pages.deduce_classes(frame).filter(f"token = {said}").collect()}
    assert set(found) == {"order", "nesting", "fixed"}
    assert found["order"].kept_order < pages.HOLDS and found["order"].n_pages == 8
    assert found["nesting"].kept_gap == 0.5 and found["nesting"].kept_order == 1
    assert found["fixed"].kept_gap == 1 and found["fixed"].kept_order == 1


def test_longest_rising_order():
    assert pages.out_of_order([1, 2, 3]) == set()
    assert pages.out_of_order([]) == set()
    assert len(pages.out_of_order([3, 1, 2])) == 1 and pages.out_of_order([3, 1, 2]) == {0}
    assert pages._misplaced([1, 3, 2, 4], [False, True, False, False]) == {1}
    assert pages._misplaced([1, 2, 4, 3], [False, True, False, True]) == {3}


def test_deep_and_long_pages(spark):
    deep = "<div>" * 30_000 + "<p>down here</p>" + "</ul>" * 30_000 + "</div>" * 30_000
    long = "<article>" + "".join(f"<section><p>part {k}</p></section>" for k in range(20_000)) + "</article>"
    rows = [(i, f"http://deep.example/{i}", h) for i, h in enumerate((deep, deep, long, None))]
    got = {r.page_id: r.text for r in pages.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: "down here", 1: "down here", 2: "\n".join(f"part {k}" for k in range(20_000)), 3: ""}
