"""Column helpers shared by the operators: missing values, words, keyed replies, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The field mark of replies, image marks of markdown, one white-space class for both engines.
MARK = "<|#|>"
IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"
WORD = r"[^ \t\n\r\f\x0b]+"
SPACE = r"[ \t\n\r\f\x0b]+"
MISSING = ["", "None", "null"]


def is_missing(c: Column) -> Column:
    return c.isNull() | c.isin(MISSING)


def upper(text: str) -> str:
    """Capitals letter by letter, as SQL has them: 'ß' becomes 'ẞ', and a letter whose capital takes several letters stays."""

    def one(c: str) -> str:
        several = c.upper(), "ẞ" if c == "ß" else c.title(), c
        return next(u for u in several if len(u) == 1)

    return text.upper() if text.isascii() else "".join(map(one, text))


def word_count(c: Column) -> Column:
    """Runs of other characters than ASCII white space, by cutting at white space, which costs half of matching words."""
    c = F.coalesce(c, F.lit(""))
    edge = lambda side: F.when(side(c, F.lit(1)).isin(*" \t\n\r\f\x0b"), 1).otherwise(0)
    return F.when(c == "", 0).otherwise(F.size(F.split(c, SPACE)) - edge(F.left) - edge(F.right)).cast("long")


def letter_words(c: Column) -> Column:
    """The words `[a-z]+` of the text in lower case, by cutting at other characters."""
    return F.array_remove(F.split(F.lower(c), "[^a-z]+"), "")


def token_estimate(c: Column) -> Column:
    """Words times 1.3, rounded down."""
    return F.floor(word_count(c) * F.lit(1.3)).cast("long")


def clean(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}|{SPACE}$", "")


def keyed(reply: Column, key: str, last: bool = False) -> Column:
    """The value after key in a reply of marked fields; else of a line 'key: value'; null if absent.

    Text before START and after END is cut. The last occurrence counts where last is set, else the first.
    """
    body = F.regexp_replace(F.regexp_replace(reply, r"(?s)^.*?START<\|#\|>", ""), r"(?s)<\|#\|>END<\|#\|>.*$", "")
    parts = F.transform(F.split(body, r"<\|#\|>"), clean)
    names = F.transform(parts, F.lower)
    at = F.array_position(names, key.lower())
    if last:
        at = F.when(at > 0, F.size(parts) - F.array_position(F.reverse(names), key.lower()) + 1).otherwise(0)
    marked = F.when(at > 0, F.try_element_at(parts, (at + 1).cast("int")))
    plain = F.regexp_extract(reply, rf"(?im)^[ \t]*{key}[ \t]*:[ \t]*(.*)$", 1)
    return F.coalesce(marked, F.when(plain != "", clean(plain)))


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v: str | Column) -> Column:
    """The vector over its length; a zero vector stays."""
    v = F.col(v) if isinstance(v, str) else v
    # bound once, so that nested uses do not repeat the expression
    sized = F.transform(F.array(v), lambda u: F.struct(u.alias("u"), F.sqrt(dot(u, u)).alias("n")))
    return F.element_at(F.transform(sized, lambda s: F.when(s["n"] > 0, F.transform(s["u"], lambda x: x / s["n"])).otherwise(s["u"])), 1)


def cosine(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def hashed_words(text: Column, dims: int = 64) -> Column:
    """A plain encoder of built-in functions: counts of words `[a-z]+` in dims buckets by length, first and last letter, of unit length; zero without words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    bucket = lambda w: F.pmod(F.length(w) * 31 + F.ascii(w) * 7 + F.ascii(F.right(w, F.lit(1))) * 13, F.lit(dims))
    counted = F.transform(F.array(F.transform(words, bucket)), lambda b: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.size(F.filter(b, lambda x: x == i)).cast("double")))
    return l2_normalize(F.element_at(counted, 1))
