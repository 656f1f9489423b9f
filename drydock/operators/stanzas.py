"""Variable definitions out of a dictionary's running text.

A ``COLUMN:`` line opens a stanza which reaches to the next one. Within it the
data type and the short description follow their labels, and free text follows
the description until a stop phrase. Section markers name the table of the
stanzas after them, but count only where no open stanza has taken the line in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from drydock.config import DictionaryGrammar
from drydock.functions.text import (
    before_parenthesis, collapse_blanks, contains_any, is_page_number, without_label)
from drydock.operators.sequences import Running, explode_lines, scan, with_blocks, with_sequence_key

# A line's place in its document: page and line number in one ordered integer.
_LINES_PER_PAGE = 2**31
PAGES_PER_BLOCK = 512


def compose_description(short: Column, body: Column) -> Column:
    """``short. body``, or whichever of the two there is."""
    body = collapse_blanks(body)
    return F.when(F.coalesce(body, F.lit("")) == "", short).when(
        F.coalesce(short, F.lit("")) == "", body).otherwise(F.concat(short, F.lit(". "), body))


def definition_name(line: Column, grammar: DictionaryGrammar = DictionaryGrammar()) -> Column:
    """The variable named by a ``COLUMN:`` line, without label and alias."""
    return F.upper(before_parenthesis(without_label(line, grammar.column_label)))


def section_marker(line: Column, grammar: DictionaryGrammar = DictionaryGrammar()) -> Column:
    """The table a line announces; the first marker in order wins, else null."""
    found = F.lit(None).cast("string")
    for marker in reversed(grammar.markers):
        found = F.when(contains_any(line, marker.phrases), F.lit(marker.table)).otherwise(found)
    return found


def dictionary_lines(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """Non-blank lines as ``(_key, _block, pos, line)``, the key holding ``doc``.

    Pages need not be joined first: the blank line between two pages means
    nothing to the grammar.
    """
    cut = with_blocks(pages.select(doc, page, text), [doc], page, "_block", PAGES_PER_BLOCK)
    lines = explode_lines(cut, text, [doc, page, "_block"]).filter(F.col("line") != "")
    placed = lines.select(
        doc, (F.col(page).cast("bigint") * F.lit(_LINES_PER_PAGE) + F.col("line_no")).alias("pos"), "_block", "line")
    return with_sequence_key(placed, [doc]).drop(doc)


def parse_stanzas(pages: DataFrame, doc: str, page: str, text: str,
                  grammar: DictionaryGrammar = DictionaryGrammar()) -> DataFrame:
    """Definitions ``(doc, seq, variable, table, data_type, description,
    full_description)`` of each document, duplicates included.

    All lines are shuffled once, in blocks of whole pages. The running scans
    and their block totals read that one exchange.
    """
    line, pos = F.col("line"), F.col("pos")
    is_column = line.startswith(grammar.column_label)
    is_type = line.startswith(grammar.type_label)
    is_text = line.startswith(grammar.description_label)
    is_label = is_column | is_type | is_text
    has_stop = ~is_label & contains_any(line, grammar.stop_phrases)

    lines = dictionary_lines(pages, doc, page, text).repartition("_key", "_block")
    opened = scan(lines, ["_key"], "pos", {
        "stanza": Running("max", F.when(is_column, pos)),
        "after_column": Running("last", F.when(is_column, True).when(is_text, False), inclusive=False),
        "stop_at": Running("max", F.when(has_stop, pos)),
    }, "_block")
    # The first description of a stanza is the one whose latest label of either
    # kind is the column itself.
    worded = scan(opened, ["_key"], "pos", {
        "text_at": Running("max", F.when(is_text & F.col("after_column"), pos)),
    }, "_block")
    in_text = F.col("text_at") > F.col("stanza")
    stopped = F.coalesce(in_text & (F.col("stop_at") > F.col("text_at")), F.lit(False))
    visible = F.col("stanza").isNull() | is_column | stopped
    placed = scan(worded, ["_key"], "pos", {
        "table": Running("last", F.when(visible, section_marker(line, grammar))),
    }, "_block")

    is_body = in_text & ~is_label & ~is_page_number(line, grammar.max_page_number_digits)
    facts = placed.filter(F.col("stanza").isNotNull() & ~stopped).select(
        F.col("_key")[doc].alias(doc), "stanza", "pos", "line", "table",
        is_column.alias("is_column"), is_type.alias("is_type"), is_text.alias("is_text"),
        F.coalesce(is_body, F.lit(False)).alias("is_body"))
    stanzas = (
        facts.filter("is_column OR is_type OR is_text OR is_body")
        .groupBy(doc, "stanza").agg(
            F.max(F.when(F.col("is_column"), line)).alias("name_line"),
            F.max(F.when(F.col("is_column"), F.col("table"))).alias("table"),
            F.max_by("line", F.when(F.col("is_type"), pos)).alias("type_line"),
            F.max_by("line", F.when(F.col("is_text"), pos)).alias("text_line"),
            F.expr("listagg(line, ' ') WITHIN GROUP (ORDER BY pos) FILTER (WHERE is_body)").alias("body")))
    blank = F.lit("")
    short = F.coalesce(without_label(F.col("text_line"), grammar.description_label), blank)
    return (
        stanzas.select(
            doc, F.col("stanza").alias("seq"),
            definition_name(F.col("name_line"), grammar).alias("variable"),
            F.coalesce("table", F.lit(grammar.unknown_table)).alias("table"),
            F.coalesce(without_label(F.col("type_line"), grammar.type_label), blank).alias("data_type"),
            short.alias("description"),
            compose_description(short, F.col("body")).alias("full_description"))
        .filter(F.length("variable") >= grammar.min_name_length))
