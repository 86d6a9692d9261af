"""Scalar text functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The nine labels, their accepted synonyms, and the modalities.
LABELS = ("requirement_bearing", "definition", "scope_exclusion", "scope_inclusion", "administrative", "cross_reference", "structural", "source_note", "disclaimer")
SYNONYMS = {"requirement": "requirement_bearing", "obligation": "requirement_bearing", "exclusion": "scope_exclusion", "inclusion": "scope_inclusion", "definitional": "definition", "header": "structural", "toc": "structural", "title": "structural"}
MODALITIES = ("shall", "should", "may", "must", "unspecified")
#: A span is degenerate from so many characters, white space share and spaces in a row on.
DEGENERATE = (400, 0.6, 20)
#: Words from which on a quote is looked for in Python.
LONG_QUOTE = 40


#: What (?U)\s matches: the characters of the property White_Space.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def trim_unicode(c: Column) -> Column:
    """Without white space at the ends, by a set of characters: a pattern would be tried at every place of the text."""
    return F.btrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def slugify(c: Column) -> Column:
    dashed = F.regexp_replace(F.regexp_replace(trim_unicode(F.lower(c)), r"(?U)\s+", "-"), "[^a-z0-9-]+", "-")
    slug = F.regexp_replace(F.regexp_replace(dashed, "-+", "-"), "^-|-$", "")
    return F.when(slug == "", "untitled").otherwise(slug)


def whitespace_ratio(c: Column) -> Column:
    return F.round(F.length(F.regexp_replace(c, r"(?U)\S", "")) / F.length(c), 3)


def is_degenerate(c: Column) -> Column:
    least, share, run = DEGENERATE
    return (F.length(c) >= least) & (F.length(F.regexp_replace(c, r"(?U)\S", "")) / F.length(c) >= share) & c.rlike(" {%d,}" % run)


def coerce_label(c: Column) -> Column:
    """The label itself, or after normalising one of the synonyms; else null."""
    norm = F.replace(F.replace(F.trim(F.lower(c)), F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_"))
    pairs = F.create_map(*(F.lit(x) for kv in SYNONYMS.items() for x in kv))
    known = F.coalesce(F.element_at(pairs, norm), norm)
    return F.when(c.isin(*LABELS), c).when(known.isin(*LABELS), known)


def coerce_labels(c: Column) -> Column:
    """Known labels in order, each once."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), coerce_label), lambda x: x.isNotNull()))


def coerce_modality(c: Column) -> Column:
    norm = F.trim(F.lower(F.coalesce(c, F.lit("unspecified"))))
    return F.when(norm.isin(*MODALITIES), norm).otherwise("unspecified")


def clean_tags(c: Column) -> Column:
    """Empty tags go, the rest is trimmed and lowered."""
    return F.transform(F.filter(c, lambda t: t.isNotNull() & (t != "")), lambda t: F.lower(trim_unicode(t)))


def loose_contains(text: Column, quote: Column) -> Column:
    return F.contains(squeeze(text), squeeze(quote))


#: A piece of a word, up to a hyphen or the word's end, and what stands behind it.
PIECES = re.compile(r"([^\s,;-]*-|[^\s,;-]+)([\s,;]*)")
#: What may stand behind a piece: inside a word, between words, and between words behind a hyphen.
INSIDE, BETWEEN, BEHIND_HYPHEN = re.compile(r"\s*"), re.compile(r"[,;]?\s+[,;]?\s*"), re.compile(r"\s*[,;]?\s+[,;]?\s*")


def place_of(quote: str, text: str) -> str | None:
    """The first place in text that has the words of quote, of which there are two or more: commas, semicolons and wraps may
    stand between, and wraps behind hyphens. Both are cut into pieces, so work grows with their lengths, and no pattern is
    made of the quote."""
    asked = PIECES.findall(" ".join(re.sub("[,;]", "", quote).split()))
    n = len(asked)
    if n < 2:
        return None
    have = PIECES.findall(text)
    words = [w for w, _ in have]
    first, middle, last = asked[0][0], [w for w, _ in asked[1:-1]], asked[-1][0]
    rules = [INSIDE if not gap else BEHIND_HYPHEN if w.endswith("-") else BETWEEN for w, gap in asked[:-1]]
    for k in range(len(have) - n + 1):
        if not words[k].endswith(first) or middle and words[k + 1] != middle[0] or not words[k + n - 1].startswith(last):
            continue
        if words[k + 1 : k + n - 1] == middle and all(r.fullmatch(gap) for r, (_, gap) in zip(rules, have[k : k + n - 1], strict=True)):
            size = lambda rows: sum(len(w) + len(gap) for w, gap in rows)
            begin = len(text) - size(have[k:]) + len(words[k]) - len(first)
            end = len(text) - size(have[k + n - 1 :]) + len(last)
            return text[begin : INSIDE.match(text, end).end() if last.endswith("-") else end]
    return None


def long_quotes(quotes: pa.Array, texts: pa.Array) -> pa.Array:
    """canonical_quote for many words, on which the JVM's pattern matcher would exhaust its stack."""
    pairs = zip(quotes.to_pylist(), texts.to_pylist(), strict=True)
    return pa.array([place_of(quote, text) if quote and text else None for quote, text in pairs], pa.string())


def long_quote_lists(quotes: pa.Array, texts: pa.Array) -> pa.Array:
    """long_quotes for lists of quotes as JSON, null where a quote is null. Not as Arrow lists: Spark measures those anew for every row of a batch."""
    told = lambda qs, text: json.dumps([place_of(q, text) if q and text else None for q in json.loads(qs)])
    return pa.array([told(qs, text) if qs else None for qs, text in zip(quotes.to_pylist(), texts.to_pylist(), strict=True)], pa.string())


def words_of(quote: Column) -> Column:
    """The words of a quote, without commas and semicolons, parted by one space."""
    return squeeze(F.regexp_replace(quote, "[,;]", ""))


def many_words(plain: Column) -> Column:
    return F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) >= LONG_QUOTE


def loose_pattern(plain: Column) -> Column:
    """The pattern of words parted by one space: commas, semicolons and wraps may stand between, wraps behind hyphens."""
    escaped = F.replace(F.regexp_replace(plain, r"([\\\[\](){}.*+?^$|])", r"\\$1"), F.lit("-"), F.lit(r"-\s*"))
    return F.concat(F.lit("(?U)"), F.replace(escaped, F.lit(" "), F.lit(r"[,;]?\s+[,;]?\s*")))


def first_match(text: Column, pattern: Column) -> Column:
    """What the pattern matches first, else null; regexp_substr would look for it twice."""
    return F.get(F.regexp_extract_all(text, pattern, F.lit(0)), 0)


def canonical_quote(quote: Column, text: Column) -> Column:
    """The words of quote as text has them, whatever the wraps, commas and semicolons between; else the quote."""
    plain = words_of(quote)
    # counted apart from the words' pattern, which long quotes need not have
    exact, long = (quote == "") | F.contains(text, quote) | (plain == ""), many_words(plain)
    found = F.when(~exact & ~long, first_match(text, loose_pattern(plain)))
    wide = F.arrow_udf(long_quotes, "string")(F.when(~exact & long, quote), F.when(~exact & long, text))
    return F.coalesce(found, wide, quote)


def canonical_quotes(quotes: Column, text: Column) -> Column:
    """canonical_quote of each of a list, in place: a list's rows are never dealt out and gathered again."""
    asked = F.transform(quotes, lambda q: F.when((q != "") & ~F.contains(text, q), F.struct(q.alias("q"), words_of(q).alias("plain"))))
    short = F.transform(asked, lambda x: F.when((x["plain"] != "") & ~many_words(x["plain"]), first_match(text, loose_pattern(x["plain"]))))
    some = F.exists(quotes, lambda q: F.length(q) > 2 * LONG_QUOTE)  # so many words have as many spaces
    long = F.when(some, F.transform(asked, lambda x: F.when(many_words(x["plain"]), x["q"])))
    wide = F.from_json(F.arrow_udf(long_quote_lists, "string")(F.to_json(long), F.when(some, text)), "array<string>")
    either = lambda a, b: F.coalesce(a, b)
    return F.zip_with(F.coalesce(F.zip_with(short, wide, either), short), quotes, either)


def defined_term(text: Column) -> Column:
    """X of "X means", after an optional marker; null beyond 80 characters."""
    term = trim_unicode(F.regexp_extract(trim_unicode(text), r"(?s)^(?:\([a-z0-9]+\)\s+)?(.+?)\s+means\b", 1))
    return F.when((term != "") & (F.length(term) <= 80), term)


def definition_parts(text: Column) -> tuple[Column, Column]:
    """Term and body of "(1) X means ...": what stands before " means ", after a first closing bracket, and the rest; without it no term and the whole text."""
    has, whole = F.contains(text, F.lit(" means ")), trim_unicode(text)
    head = F.substring_index(whole, " means ", 1)
    term = F.when(F.contains(head, F.lit(")")), F.substring(head, F.instr(head, F.lit(")")) + 1, F.length(head))).otherwise(head)
    body = F.substring(whole, F.length(head) + 2, F.length(whole))
    return F.when(has, trim_unicode(term)).otherwise(""), F.when(has, trim_unicode(body)).otherwise(whole)


def doc_part(slug: Column) -> Column:
    """The part that a slug such as 21-cfr-part-11 ends in; null for others."""
    return F.nullif(F.regexp_extract(slug, r"21-cfr-part-(\d+)$", 1), F.lit(""))


def cited_part(citation: Column) -> Column:
    """The part of a citation: after "21 CFR", after "part", or before the dot of a section."""
    first = lambda rx: F.nullif(F.regexp_extract(citation, rx, 1), F.lit(""))
    return F.coalesce(first(r"(?i)\b21\s+CFR\s+(\d+)(?:\.\d+)?"), first(r"\b[Pp]art\s+(\d+)\b"), first(r"(\d+)\.\d+"))


def stable_hash(*parts: Column) -> Column:
    """16 hex digits over the parts, joined by the unit separator."""
    return F.substring(F.sha2(F.concat_ws("\u001f", *parts), 256), 1, 16)


def global_id(doc_id: Column, local_id: Column) -> Column:
    return F.concat_ws(":", doc_id, local_id)


def split_global(c: Column) -> tuple[Column, Column]:
    """Document and local id, at the last colon."""
    local = F.substring_index(c, ":", -1)
    return F.substring(c, F.lit(1), F.length(c) - F.length(local) - 1), local


def numbered(prefix: str, width: int, n: Column) -> Column:
    """prefix and n, padded to width at least."""
    return F.concat(F.lit(prefix), F.when(F.length(n.cast("string")) >= width, n.cast("string")).otherwise(F.lpad(n.cast("string"), width, "0")))


def cut(c: Column, most: int) -> Column:
    """At most so many characters, an ellipsis in place of the rest."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def preview(c: Column, most: int) -> Column:
    return F.substring(F.replace(trim_unicode(c), F.lit("\n"), F.lit(" ")), 1, most)


def escape_html(c: Column) -> Column:
    for raw, told in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"), ("\n", "<br>")):
        c = F.replace(c, F.lit(raw), F.lit(told))
    return c


def clean_paragraph(c: Column) -> Column:
    """Wrapped lines are joined unless the next one opens a marker; blank runs collapse."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\n(?!\()", " "), "[ \t]+", " "))


def unfence(c: Column) -> Column:
    """The inside of a fenced block, if the text is one."""
    inner = F.regexp_extract(c, r"(?s)^\s*```[a-zA-Z]*\n(.*?)\n?```\s*$", 1)
    return F.when(inner != "", inner).otherwise(c)


def repair_json(c: Column) -> Column:
    """A bracket that follows a key's text and closes no list goes, and so do commas before a closing bracket."""
    return F.regexp_replace(F.regexp_replace(unfence(c), r'(":\s*"[^"]*")\]', "$1"), r",(\s*[}\]])", "$1")


# What a refusal for a wrong key says, what stands in its place, and keys inside messages.
KEY_REFUSED = ("invalid_api_key", "Incorrect API key provided")
KEY_PATTERNS = ((r"sk-[A-Za-z0-9_-]{8,}", "sk-[redacted]"), (r"(?i)(api[_ -]?key[^:]*:\s*)[^,}\n]+", "$1[redacted]"))
MESSAGE_CHARS = 1000
#: Our own, beside those: tokens and authorization headers.
TOKEN_PATTERN = (r"(?i)((?:api[_-]?key|token|authorization|bearer)[\"':=\s]+)[A-Za-z0-9._-]{8,}", "$1[redacted]")


def redact_keys(c: Column) -> Column:
    """A message without keys, at most MESSAGE_CHARS long; a refusal for a wrong key is named, and nothing of it kept."""
    out = c
    for rx, told in (*KEY_PATTERNS, TOKEN_PATTERN):
        out = F.regexp_replace(out, rx, told)
    refused = F.contains(c, F.lit(KEY_REFUSED[0])) | F.contains(c, F.lit(KEY_REFUSED[1]))
    return F.when(refused, KEY_REFUSED[0]).otherwise(F.substring(out, 1, MESSAGE_CHARS))


def roman(n: Column) -> Column:
    """Roman numeral of 1 to 3999."""
    digits = (("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"), ("", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"), ("", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"), ("", "M", "MM", "MMM"))
    place = lambda names, unit: F.element_at(F.array(*map(F.lit, names)), (F.floor(n / unit) % 10 + 1).cast("int"))
    return F.when(n.between(1, 3999), F.concat(place(digits[3], 1000), place(digits[2], 100), place(digits[1], 10), place(digits[0], 1)))


def from_roman(c: Column) -> Column:
    """The number of a canonical numeral of either case; null for others such as iiii."""
    up = F.upper(c)
    worth = F.create_map(*(F.lit(x) for kv in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in kv))
    values = F.transform(F.split(up, ""), lambda x: F.element_at(worth, x))
    total = F.aggregate(F.zip_with(values, F.slice(values, F.lit(2), F.size(values)), lambda a, b: F.when(a < b, -a).otherwise(a)), F.lit(0), lambda s, x: s + x)
    return F.when(up.rlike("^[IVXLCDM]+$") & (roman(total) == up), total)


def first_rule(line: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The name of the first rule that a line matches, else null."""
    out = None
    for name, rx in rules:
        out = F.when(line.rlike(rx), name) if out is None else out.when(line.rlike(rx), name)
    return out if out is not None else F.lit(None).cast("string")
