"""Text matching and template string functions as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accents and case don't matter under this collation.
FOLDED = "UNICODE_CI_AI"



def _without_marks() -> dict[str, str]:
    """Every lower-case letter of the basic plane that is another letter with marks, and that letter."""
    out = {}
    for c in map(chr, range(0xC0, 0x10000)):
        first, *marks = unicodedata.normalize("NFD", c)
        if marks and c == c.lower() and all(unicodedata.combining(m) for m in marks):
            out[c] = first
    return out


_BARE = _without_marks()


def normalized(text: Column) -> Column:
    """Lower case without diacritics, also of decomposed letters."""
    return F.regexp_replace(F.translate(F.lower(text), "".join(_BARE), "".join(_BARE.values())), r"\p{Mn}", "")


def contains_folded(text: Column, part: Column) -> Column:
    return F.contains(F.collate(text, FOLDED), F.collate(part, FOLDED))


def query_terms(query: str) -> list[str]:
    """A query is cut as texts are: its terms are runs of letters and digits."""
    return "".join(c if c.isalnum() else " " for c in query.lower()).split()


def all_terms_match(text: Column, query: str) -> Column:
    """Every term of the query is a word of the text, the last one a word's beginning (our decision). A query of
    punctuation only finds nothing, an empty one everything."""
    own, terms = F.lower(text), query_terms(query)
    out = F.lit(bool(terms) or not query.strip())
    for i, term in enumerate(terms):
        end = "" if i == len(terms) - 1 else r"(?![\p{L}\p{N}])"
        out = out & own.rlike(rf"(?<![\p{{L}}\p{{N}}]){term}{end}")
    return out


def highlight(text: Column, part: Column) -> tuple[Column, Column]:
    """Where the first match starts and ends, in characters from 0; null without a match or without a query."""
    start = F.instr(normalized(text), normalized(part))
    found = (start > 0) & (part != "")
    return F.when(found, start - 1), F.when(found, start - 1 + F.length(normalized(part)))


def country_matches(query: Column, name: Column, currency: Column, iso: Column, aliases: Column, label_start: bool = False, alias_exact: bool = False) -> Column:
    """A country is shown if its name or currency holds the query, its code is the query, or an alias starts with it."""
    q, label = normalized(query), normalized(name)
    by_name = label.startswith(q) if label_start else F.contains(label, q)
    by_alias = F.exists(aliases, lambda a: normalized(a) == q if alias_exact else normalized(a).startswith(q))
    some = by_name | F.contains(normalized(currency), q) | (normalized(iso) == q) | by_alias
    return F.when(q == "", True).otherwise(F.coalesce(some, F.lit(False)))


def handleize(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-|-$", "")


def capitalize(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def truncate(text: Column, size: int, end: str = "...") -> Column:
    """At most size characters, the end included."""
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, max(0, size - len(end))), F.lit(end))).otherwise(text)


def truncate_words(text: Column, count: int, end: str = "...") -> Column:
    words = F.split(F.trim(text), r"\s+")
    return F.when(F.size(words) > count, F.concat(F.array_join(F.slice(words, 1, count), " "), F.lit(end))).otherwise(text)


def strip_html(text: Column) -> Column:
    bare = F.regexp_replace(text, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    return F.regexp_replace(bare, r"<[^>]*>", "")


def escape_html(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def newline_to_br(text: Column) -> Column:
    return F.regexp_replace(text, r"\r?\n", "<br />\n")


def strip_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"[\r\n]", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def canonical_query(params: Column) -> Column:
    """A request's key: its parameters (an array of name=value) in order."""
    return F.array_join(F.array_sort(params), "&")
