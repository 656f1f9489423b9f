"""The dictionary grammar: one test per rule, and a simple reader as referee."""

import random

import pytest

from drydock.config import DictionaryGrammar
from drydock.operators import stanzas as module
from drydock.operators.dictionary import build_dictionary, preview, section_counts, without_definitions
from drydock.operators.stanzas import parse_stanzas


def parse(spark, *pages, doc="d"):
    df = spark.createDataFrame([(doc, i, t) for i, t in enumerate(pages)], "doc string, page bigint, text string")
    rows = parse_stanzas(df, "doc", "page", "text").orderBy("doc", "seq").collect()
    return [(r.variable, r.table, r.data_type, r.description, r.full_description) for r in rows]


def test_a_plain_stanza(spark):
    assert parse(spark, "SECTION IV\n  COLUMN: ab_c (alias) (x)\nDATA TYPE: INT [4]\nDESCRIPTION: Short\n"
                        " long  text\n\n12\nmore\t1234") == [
        ("AB_C", "ATTRIBUTES", "INT [4]", "Short", "Short. long text more 1234")]


def test_markers_in_order_of_precedence(spark):
    def table(marker):
        return parse(spark, f"{marker}\nCOLUMN: AA\nDESCRIPTION: x")[0][1]

    assert table("SECTION V") == "UNKNOWN"
    assert table("SECTION V of it") == "RELATIONSHIPS"
    assert table("SECTION VII") == "TRANSFORMATIONS"
    assert table("SECTION IV and SECTION VI") == "TRANSFORMATIONS"
    assert table("see ATTRIBUTES TABLE DETAILS") == "ATTRIBUTES"
    assert table("ATTRIBUTES TABLE") == "UNKNOWN"


def test_stop_only_after_description_and_not_on_labels(spark):
    assert parse(spark, "COLUMN: AA\nATTRIBUTES TABLE\nDESCRIPTION: see SECTION IV\nbody\nDATA TYPE: SECTION V\nend") == [
        ("AA", "UNKNOWN", "SECTION V", "see SECTION IV", "see SECTION IV. body end")]


def test_marker_before_description_is_swallowed(spark):
    found = parse(spark, "COLUMN: AA\nSECTION IV\nDESCRIPTION: x\nCOLUMN: BB\nDESCRIPTION: y")
    assert [f[1] for f in found] == ["UNKNOWN", "UNKNOWN"]


def test_after_a_stop_markers_count_and_text_does_not(spark):
    found = parse(spark, "COLUMN: AA\nDESCRIPTION: x\nRELATIONSHIPS TABLE\nlost\nDATA TYPE: LOST\n"
                         "DESCRIPTION: lost\nSECTION VI\nCOLUMN: BB\nDESCRIPTION:\nbody only")
    assert found == [("AA", "UNKNOWN", "", "x", "x"), ("BB", "TRANSFORMATIONS", "", "", "body only")]


def test_marker_on_the_column_line(spark):
    assert parse(spark, "COLUMN: AA SECTION IV\nDESCRIPTION: x")[0][:2] == ("AA SECTION IV", "ATTRIBUTES")


def test_names_and_fields(spark):
    assert parse(spark, "COLUMN: A\nDESCRIPTION: x\nCOLUMN:\nCOLUMN: (B)\nCOLUMN: CC\nDATA TYPE: 1\nDATA TYPE: 2\n"
                        "DESCRIPTION: one\nmid\nDESCRIPTION: two\n123\n1234\nCOLUMN: DD") == [
        ("CC", "UNKNOWN", "2", "two", "two. mid 1234"), ("DD", "UNKNOWN", "", "", "")]


def test_pages_are_one_text(spark):
    assert parse(spark, "SECTION IV\nCOLUMN: AA", "DESCRIPTION: x\nbody", "", "7\nrest") == [
        ("AA", "ATTRIBUTES", "", "x", "x. body rest")]


# -- referee ---------------------------------------------------------------------


def referee(text, grammar=DictionaryGrammar()):
    """A reader which steps through the lines with a phase:
    0 no stanza, 1 column seen, 2 description seen, 3 stopped."""
    phase, table, stanza, out = 0, grammar.unknown_table, None, []
    for line in (x.strip() for x in text.split("\n")):
        opens = line.startswith(grammar.column_label)
        label = next((n for n in (grammar.type_label, grammar.description_label) if line.startswith(n)), None)
        if phase == 2 and not opens and label is None and any(p in line for p in grammar.stop_phrases):
            phase = 3
        if phase in (0, 3) or opens:
            table = next((m.table for m in grammar.markers if any(p in line for p in m.phrases)), table)
        if opens:
            phase = 1
            stanza = {"name": line.replace(grammar.column_label, "").strip().split("(")[0].strip().upper(),
                      "table": table, "type": "", "short": "", "body": []}
            out.append(stanza)
        elif phase in (1, 2):
            if label == grammar.type_label:
                stanza["type"] = line.replace(label, "").strip()
            elif label:
                stanza["short"], phase = line.replace(label, "").strip(), 2
            elif phase == 2 and line and not (line.isdigit() and len(line) <= 3):
                stanza["body"].append(line)
    rows = []
    for s in out:
        body = " ".join(" ".join(s["body"]).split())
        full = f"{s['short']}. {body}" if s["short"] and body else body or s["short"]
        if len(s["name"]) >= 2:
            rows.append((s["name"], s["table"], s["type"], s["short"], full))
    return rows


LINES = ["COLUMN: AB", "COLUMN: CD (x)", " COLUMN: E", "DATA TYPE: INT", "DATA TYPE: SECTION IV", "DESCRIPTION: words",
         "DESCRIPTION:", "free text", "more  text", "12", "1234", "", "SECTION IV", "SECTION V ", "SECTION V x",
         "SECTION VI", "SECTION VII", "ATTRIBUTES TABLE", "RELATIONSHIPS TABLE DETAILS", "COLUMN: FG SECTION VI",
         "TRANSFORMATIONS TABLE DETAILS here", "text COLUMN: no"]


@pytest.mark.parametrize("pages_per_block", [1, 2, 512])
def test_against_the_referee(spark, monkeypatch, pages_per_block):
    """Random documents, one far longer than the others, cut into pages and blocks."""
    monkeypatch.setattr(module, "PAGES_PER_BLOCK", pages_per_block)
    rng = random.Random(pages_per_block)
    rows, want = [], {}
    for d in range(60):
        lines = [rng.choice(LINES) for _ in range(900 if d == 0 else rng.randint(0, 40))]
        want[f"d{d}"] = referee("\n".join(lines))
        page = 0
        while lines:
            n = rng.randint(1, 6)
            rows.append((f"d{d}", page, "\n".join(lines[:n])))
            lines, page = lines[n:], page + 1
    df = spark.createDataFrame(rows, "doc string, page bigint, text string").repartition(7)
    found = {}
    for r in parse_stanzas(df, "doc", "page", "text").orderBy("doc", "seq").collect():
        found.setdefault(r.doc, []).append((r.variable, r.table, r.data_type, r.description, r.full_description))
    assert found == {d: rows for d, rows in want.items() if rows}


def test_routes_per_document(spark):
    pages = spark.createDataFrame(
        [("both", 0, "COLUMN: TEXT_ONE\nDESCRIPTION: a"), ("text", 0, "COLUMN: TEXT_TWO\nDESCRIPTION: b"),
         ("none", 0, "just words"), ("barren", 0, "COLUMN: TEXT_THREE\nDESCRIPTION: c")],
        "doc string, page bigint, text string")
    cells = spark.createDataFrame(
        [("both", 1, 0, 0, "Name"), ("both", 1, 0, 1, "Description"), ("both", 1, 1, 0, "grid_one"), ("both", 1, 1, 1, "g"),
         ("barren", 1, 0, 0, "Name"), ("barren", 1, 0, 1, "Text"), ("barren", 1, 1, 0, "not a name"), ("barren", 1, 1, 1, "g")],
        "doc string, table_id int, row_no int, col_no int, text string")
    built = build_dictionary(cells, pages, "doc", "page", "text")
    assert {(r.doc, r.variable, r.route) for r in built.collect()} == {
        ("both", "GRID_ONE", "grid"), ("text", "TEXT_TWO", "text"), ("barren", "TEXT_THREE", "text")}
    assert [r.doc for r in without_definitions(pages, built, "doc", "page").collect()] == ["none"]
    seen = parse_stanzas(pages, "doc", "page", "text")
    assert {r.doc: r.n for r in section_counts(seen, "doc", "seq").collect()} == {"both": 1, "text": 1, "barren": 1}
    assert preview(seen, ["doc"], 2).columns == ["variable", "table", "data_type", "description"]
