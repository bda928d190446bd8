"""Report text, JSON replies and evidence spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.predicates import strip

WS_CLASS = r"(?U)\s"


def unfence(content: Column) -> Column:
    """Drop a surrounding Markdown code fence and its ``json`` tag."""
    text = strip(content)
    bare = F.btrim(text, F.lit("`"))
    bare = F.when(F.lower(F.substring(bare, 1, 4)) == "json", F.substring(bare, 5, 2_147_483_647)).otherwise(bare)
    return F.when(text.startswith("```"), strip(bare)).otherwise(text)


def json_object_error(text: Column) -> Column:
    """Null for one non-empty JSON object, else ``invalid_json`` or ``empty_or_non_object``."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    # the parser stops after the first value; inside either bracket, trailing text is a syntax error
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNull() | F.try_parse_json(
        F.concat(F.lit('{"x":'), text, F.lit("}"))).isNull()
    return (
        F.when(text.isNull() | kind.isNull() | boxed, F.lit("invalid_json"))
        .when(~kind.startswith("OBJECT<") | (kind == "OBJECT<>"), F.lit("empty_or_non_object"))
    )


def parse_json_content(content: Column) -> Column:
    """struct(text, error): the unfenced reply and why it is not one JSON object, if so."""
    text = unfence(content)
    return F.struct(text.alias("text"), json_object_error(text).alias("error"))


def select_message(content: Column, reasoning: Column, finish_reason: Column, allow_reasoning: Column) -> Column:
    """struct(field, raw, reason): which message field holds the JSON reply.

    Content wins. The reasoning field counts only when it is allowed and content is
    blank. A reply cut off by the server is never read.
    """
    blank_c = F.coalesce(strip(content) == "", F.lit(True))
    blank_r = F.coalesce(strip(reasoning) == "", F.lit(True))
    cut = F.coalesce(finish_reason != "stop", F.lit(False))
    field = F.when(~blank_c, F.lit("content")).when(allow_reasoning & ~blank_r, F.lit("reasoning_content"))
    raw = F.when(~blank_c, content).when(allow_reasoning & ~blank_r, reasoning)
    bad = json_object_error(raw)
    reason = (
        F.when(cut, F.lit("truncated_response"))
        .when(field.isNull(), F.lit("empty_content"))
        .when((bad == "invalid_json") & (field == "reasoning_content"), F.lit("reasoning_not_json_object"))
        .otherwise(bad)
    )
    return F.struct(
        F.when(reason.isNull(), field).alias("field"), F.when(reason.isNull(), raw).alias("raw"),
        reason.alias("reason"))


def whitespace_pattern(span: Column) -> Column:
    """Regex matching the span with any whitespace run where the span has one."""
    escaped = F.regexp_replace(span, r"([\\\[\](){}.*+?^$|#&~-])", r"\\$1")
    return F.concat(F.lit("(?U)"), F.regexp_replace(escaped, WS_CLASS + "+", r"\\s+"))


def recover_span(span: Column, report: Column) -> Column:
    """struct(span, repaired): a span that differs only in whitespace gets its unique source text."""
    verbatim = F.contains(report, span)
    usable = span.isNotNull() & (span != "") & ~verbatim
    pattern = F.when(usable, whitespace_pattern(span))
    unique = F.coalesce(F.regexp_count(report, pattern) == 1, F.lit(False))
    return F.struct(
        F.when(unique, F.regexp_substr(report, pattern)).otherwise(span).alias("span"), unique.alias("repaired"))


def evidence_error(state: Column, span: Column, report: Column) -> Column:
    """``missing_evidence`` / ``evidence_not_in_report`` / null for one target."""
    text = F.coalesce(span, F.lit(""))
    absent = (text != "") & ~F.contains(report, text)
    return (
        F.when(F.coalesce(state, F.lit("")).eqNullSafe("not_mentioned"),
               F.when(absent, F.lit("evidence_not_in_report")))
        .when(text == "", F.lit("missing_evidence"))
        .when(absent, F.lit("evidence_not_in_report"))
    )


def context_chars(context_tokens: Column, output_tokens: Column) -> Column:
    """Characters that fit the model context: at least 512 tokens, 4 characters each."""
    return F.greatest(F.lit(512), context_tokens - output_tokens - 256) * 4


def split_report(report: Column, max_chars: Column) -> Column:
    """Paragraph-packed chunks no longer than ``max_chars``; null when one paragraph alone is too long."""
    paragraphs = F.split(report, "\n\n", -1)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"))

    def step(acc: Column, para: Column) -> Column:
        buf = acc["buf"]
        full = (buf != "") & (F.length(buf) + 2 + F.length(para) > max_chars)
        return F.struct(
            F.when(full, F.array_append(acc["done"], buf)).otherwise(acc["done"]).alias("done"),
            F.when(full | (buf == ""), para).otherwise(F.concat(buf, F.lit("\n\n"), para)).alias("buf"))

    def finish(acc: Column) -> Column:
        return F.when(acc["buf"] != "", F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"])

    packed = F.aggregate(paragraphs, start, step, finish)
    oversize = F.exists(paragraphs, lambda p: F.length(p) > max_chars)
    return (
        F.when(F.length(report) <= max_chars, F.array(report))
        .when(~oversize & (F.size(packed) > 0), packed)
    )
