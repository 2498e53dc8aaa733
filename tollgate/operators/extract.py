"""Text extraction from chat request bodies held as VARIANT.

Extraction is a per-row expression (``filter``/``transform``/``flatten`` on
``array<variant>``): message order is the array order, so there is no
explode, no regrouping and no shuffle.  Python-level failures of the
client SDKs (a ``text`` that is JSON null, a message that is not an object)
become ``extract_error = true`` rows instead of exceptions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import variant_kind


def _has(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant").isNotNull()


def _as_text_or_error(v: Column) -> Column:
    """A value that must be a string for ``"\\n".join``; anything else -> NULL
    (marks an error: JSON null or a number would raise in the client)."""
    return F.when(variant_kind(v) == "string", F.variant_get(v, "$", "string"))


def _part_pieces(content: Column, keep_bare_strings: bool) -> Column:
    parts = F.variant_get(content, "$", "array<variant>")

    def keep(p: Column) -> Column:
        k = variant_kind(p)
        is_text = (k == "object") & (F.try_variant_get(p, "$.type", "string") == "text")
        return (is_text | (k == "string")) if keep_bare_strings else is_text

    def piece(p: Column) -> Column:
        t = F.variant_get(p, "$.text", "variant")
        return (F.when(variant_kind(p) == "string", F.variant_get(p, "$", "string"))
                .when(t.isNull(), F.lit(""))
                .otherwise(_as_text_or_error(t)))

    return F.transform(F.filter(parts, keep), piece)


def _chat_pieces(body: Column, roles: tuple[str, ...], keep_bare_strings: bool) -> tuple[Column, Column]:
    msgs = F.try_variant_get(body, "$.messages", "array<variant>")

    def msg_pieces(m: Column) -> Column:
        role = F.try_variant_get(m, "$.role", "string")
        content = F.variant_get(m, "$.content", "variant")
        ck = variant_kind(content)
        return (F.when(~role.isin(*roles) | role.isNull(), F.array().cast("array<string>"))
                .when(ck == "string", F.array(F.variant_get(content, "$", "string")))
                .when(ck == "array", _part_pieces(content, keep_bare_strings))
                .otherwise(F.array().cast("array<string>")))

    pieces = F.flatten(F.transform(msgs, msg_pieces))
    bad = (msgs.isNull()
           | F.exists(msgs, lambda m: variant_kind(m) != "object")
           | F.exists(pieces, lambda x: x.isNull()))
    return pieces, bad


def message_text(m: Column, keep_bare_strings: bool = False) -> Column:
    """Text of one chat message: string content, or its text parts joined by
    line feeds; NULL where the client would raise or the content is neither."""
    content = F.variant_get(m, "$.content", "variant")
    pieces = _part_pieces(content, keep_bare_strings)
    return (F.when(variant_kind(content) == "string", F.variant_get(content, "$", "string"))
            .when((variant_kind(content) == "array") & ~F.exists(pieces, lambda x: x.isNull()), F.array_join(pieces, "\n")))


def _gemini_list(arr: Column) -> Column:
    """``contents`` as a list: strings, ``{text}`` dicts, ``{parts}`` dicts."""
    items = F.variant_get(arr, "$", "array<variant>")

    def parts_pieces(parts: Column) -> Column:
        pa = F.variant_get(parts, "$", "array<variant>")
        usable = F.filter(pa, lambda p: (variant_kind(p) == "string")
                          | ((variant_kind(p) == "object") & _has(p, "$.text")))
        arr_pieces = F.transform(usable, lambda p: F.when(
            variant_kind(p) == "string", F.variant_get(p, "$", "string"))
            .otherwise(_as_text_or_error(F.variant_get(p, "$.text", "variant"))))
        return (F.when(variant_kind(parts) == "array", arr_pieces)
                .when(variant_kind(parts) == "string",
                      F.regexp_extract_all(F.variant_get(parts, "$", "string"), F.lit("(?s)(.)"), 1))
                .otherwise(F.array(F.lit(None).cast("string"))))

    def item_pieces(it: Column) -> Column:
        k = variant_kind(it)
        return (F.when(k == "string", F.array(F.variant_get(it, "$", "string")))
                .when((k == "object") & _has(it, "$.text"),
                      F.array(_as_text_or_error(F.variant_get(it, "$.text", "variant"))))
                .when((k == "object") & _has(it, "$.parts"),
                      parts_pieces(F.variant_get(it, "$.parts", "variant")))
                .otherwise(F.array().cast("array<string>")))

    return F.flatten(F.transform(items, item_pieces))


def _innermost(c: Column) -> Column:
    """Follow objects that have ``parts`` and no ``text`` down to the first
    value that is something else.  A chain has no more links than the JSON
    has ``parts`` keys, so any depth is followed."""
    links = F.size(F.split(F.to_json(c), '"parts"'))

    def step(v: Column, _: Column) -> Column:
        follow = (variant_kind(v) == "object") & ~_has(v, "$.text") & _has(v, "$.parts")
        return F.when(follow, F.variant_get(v, "$.parts", "variant")).otherwise(v)
    return F.aggregate(F.sequence(F.lit(1), links), c, step)


def _gemini_text(c: Column) -> tuple[Column, Column]:
    """(text, error) for Gemini ``contents`` of any JSON kind, from which the
    outer ``parts`` have been taken off."""
    k = variant_kind(c)
    lst = _gemini_list(c)
    obj_text = F.variant_get(c, "$.text", "variant")
    has_text = (k == "object") & obj_text.isNotNull()
    scalar_text = (F.when(k == "null", F.lit("None"))
                   .when(k == "bool", F.when(F.variant_get(c, "$", "boolean"), "True").otherwise("False"))
                   .otherwise(F.to_json(c)))
    text = (F.when(k == "string", F.variant_get(c, "$", "string"))
            .when(k == "array", F.array_join(lst, "\n"))
            .when(has_text, _as_text_or_error(obj_text))
            .otherwise(scalar_text))
    bad = (F.when(k == "array", F.exists(lst, lambda x: x.isNull()))
           .when(has_text, variant_kind(obj_text) != "string")
           .otherwise(F.lit(False)))
    return text, bad


def extract_text(df: DataFrame, dialect: str = "openai", body: str = "body",
                 roles: Iterable[str] = ("user",), out: str = "text") -> DataFrame:
    """Add ``text`` (what the scan would see) and ``extract_error``.

    * ``openai``: user messages; string content or ``type == "text"`` parts,
      newline-joined in order; a text part with no ``text`` key gives ``""``.
    * ``anthropic``: the same, plus bare strings inside content lists.
    * ``gemini``: role-blind; string / list / dict with ``text`` or ``parts``
      (``text`` wins), nested to any depth; other values are rendered as text.
    """
    b = F.col(body)
    if dialect in ("openai", "anthropic"):
        pieces, bad = _chat_pieces(b, tuple(roles), keep_bare_strings=dialect == "anthropic")
        text = F.array_join(pieces, "\n")
    elif dialect == "gemini":
        df = df.withColumn("_inner", _innermost(F.variant_get(b, "$.contents", "variant")))
        text, bad = _gemini_text(F.col("_inner"))
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    bad = b.isNull() | F.coalesce(bad, F.lit(True))
    return (df.withColumn("extract_error", bad)
            .withColumn(out, F.when(~F.col("extract_error"), text)).drop("_inner"))
