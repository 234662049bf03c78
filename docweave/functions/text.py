"""Text functions: each takes and returns Columns, and stays inside generated code.

White space is Unicode white space unless said otherwise.  None of them turns NULL into a value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Typographic ligatures and their letters.
LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"))
#: Prefixes that DOIs are written with.
DOI_PREFIX = r"^(?:(?:https?://(?:dx\.)?doi\.org/|doi\.org/|doi:)\s*)+"
DOI_FORM = r"^10\.\d{4,9}/\S+\z"
#: How numbered headings and numbered references begin.
HEADING_NUMBER = r"^(?:\d{1,2}|[A-Z]|[IVX]+)(?:\.\d{1,2})*\.?(?:\s|$)"
REFERENCE_NUMBER = r"(?m)^\s*\[(\d+)\]"
#: What a text with a JSON value in front has at least. Any other is not handed to the parser, whose failures are dear.
JSON_AHEAD = r'(?s)^[\x{FEFF}\s]*(?:\{.*\}|\[.*\]|".*"|-?[0-9]|true|false|null)'
MAX_HEADING_LEVEL = 4
#: Share of Japanese letters from which a text is Japanese, and letters that a decision needs.
JAPANESE_SHARE, LETTERS_NEEDED = 0.10, 100
MIN_CHARS_PER_PAGE = 50
MAX_REFERENCE_NUMBER = 10_000
MAX_RECORD_NAME = 100

_WORD_SCRIPTS = r"\p{IsLatin}\p{IsGreek}\p{IsCyrillic}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, fn) -> Column:
    """``fn`` of a value that is made once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def trim_space(t) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_col(t), r"(?U)^\s+|\s+\z", "")


def collapse_space(t) -> Column:
    """Trimmed, each run of white space one blank; a line break between two non-ASCII characters goes."""
    t = F.regexp_replace(_col(t), r"(?U)([^\x00-\x7F])\s*[\r\n]\s*(?=[^\x00-\x7F])", "$1")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"^ | $", "")


def fields_joined(t) -> Column:
    """Trimmed, each run of white space one blank."""
    return F.regexp_replace(F.regexp_replace(_col(t), r"(?U)\s+", " "), r"^ | $", "")


def normalize_text(t) -> Column:
    """Line ends as LF, no blanks at line ends, trimmed; blanks inside and in front of lines stay."""
    t = F.regexp_replace(_col(t), r"\r\n?", "\n")
    return trim_space(F.regexp_replace(t, r"(?U)[\s&&[^\n]]+(?=\n|\z)", ""))


def collapse_strings(a) -> Column:
    """Each element collapsed, empty ones dropped; NULL stays NULL."""
    return F.filter(F.transform(_col(a), collapse_space), lambda x: x != "")


def heading_level(heading, level) -> Column:
    """The number of parts of a leading section number, else the level given."""
    number = F.regexp_replace(trim_space(F.regexp_extract(_col(heading), HEADING_NUMBER, 0)), r"\.+$", "")
    return F.when(number == "", _col(level)).otherwise(F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1)


def clamp_level(level) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(MAX_HEADING_LEVEL), _col(level)))


def reference_title(t) -> Column:
    """Collapsed, without one full stop at the end; an ellipsis stays."""
    c = collapse_space(t)
    return F.when(c.endswith(".") & ~c.endswith(".."), trim_space(F.substring(c, F.lit(1), F.length(c) - 1))).otherwise(c)


def doi(t) -> Column:
    """The bare lower-case DOI; NULL where the text is no DOI."""
    bare = F.regexp_replace(F.lower(collapse_space(t)), DOI_PREFIX, "")
    return F.when(bare.rlike(DOI_FORM), bare)


def doi_malformed(t) -> Column:
    """Whether a text that is not blank is no DOI."""
    return F.coalesce((collapse_space(t) != "") & doi(t).isNull(), F.lit(False))


def trimmed_cells(rows) -> Column:
    """Every cell of a table trimmed, its shape as it was."""
    return F.transform(_col(rows), lambda r: F.transform(r, trim_space))


def expand_ligatures(t) -> Column:
    t = _col(t)
    for a, b in LIGATURES:
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def lower_each(t) -> Column:
    """Lower case of each character by itself, so that a final sigma is no special case."""
    t = _col(t)
    plain = F.lower(t)
    odd = t.rlike("[Σİ]")
    apart = F.array_join(F.transform(F.split(t, ""), lambda c: F.when(c == "İ", F.lit("i")).otherwise(F.lower(c))), "")
    return F.when(odd, apart).otherwise(plain)


def is_ascii(t) -> Column:
    t = _col(t)
    return F.octet_length(t) == F.length(t)


def fold(t) -> Column:
    """Letters and digits only, ligatures as letters, lower case."""
    t = _col(t)
    any_script = F.regexp_replace(lower_each(expand_ligatures(t)), r"[^\p{L}\p{Nd}]+", "")
    return F.when(is_ascii(t), F.regexp_replace(F.lower(t), "[^a-z0-9]+", "")).otherwise(any_script)


def tokenize(t) -> Column:
    """Words of Latin, Greek, Cyrillic and digits; character pairs of other scripts.

    Only texts with letters of other scripts have their words looked at one by one.
    """
    t = _col(t)
    marked = F.regexp_replace(lower_each(expand_ligatures(t)), r"\p{Mn}+", "")
    other = rf"[\p{{L}}&&[^{_WORD_SCRIPTS}]]"
    runs = F.regexp_extract_all(marked, F.lit(rf"[a-z0-9[\p{{L}}&&[{_WORD_SCRIPTS}]]\p{{Nd}}]+|{other}+"), F.lit(0))

    def pairs(x: Column) -> Column:
        whole = (F.length(x) == 1) | x.rlike(rf"^[{_WORD_SCRIPTS}\p{{Nd}}]")
        return F.when(whole, F.array(x)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(2))))

    words = F.regexp_extract_all(F.lower(t), F.lit("[a-z0-9]+"), F.lit(0))
    return F.when(is_ascii(t), words).when(t.rlike(other), F.flatten(F.transform(runs, pairs))).otherwise(runs)


BROKEN_WORD = "[-­‐][ \\t]*\\r?\\n[ \\t]*"


def dehyphenate(t) -> Column:
    """Words broken by a hyphen at a line end made whole."""
    return F.regexp_replace(_col(t), BROKEN_WORD, "")


def token_pairs(tokens) -> Column:
    """Neighbouring tokens as unordered pairs, in order."""
    tokens = _col(tokens)
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    # Whole arrays side by side: inside a function of one element the tokens would be made anew each time.
    return F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n), lambda a, b: F.concat_ws("\x1f", F.least(a, b), F.greatest(a, b)))


def join_fragments(parts) -> Column:
    """Fragments in order, with a blank only between two ASCII characters; empty ones do not count."""
    ascii_end = lambda x: F.ascii(F.right(x, F.lit(1))) < 128
    ascii_start = lambda x: F.ascii(F.left(x, F.lit(1))) < 128
    glue = lambda a, x: F.when(a == "", x).when(x == "", a).when(ascii_end(a) & ascii_start(x), F.concat_ws(" ", a, x)).otherwise(F.concat(a, x))
    return F.aggregate(_col(parts), F.lit(""), glue)


def equal_text(a, b) -> Column:
    """Equality without case and kind of white space."""
    ci = lambda x: F.collate(fields_joined(x), "UTF8_LCASE")
    return ci(a) == ci(b)


def equal_list(a, b) -> Column:
    """Equal length and pairwise equal texts; NULL counts as empty."""
    a, b = (F.coalesce(_col(x), F.array().cast("array<string>")) for x in (a, b))
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.coalesce(equal_text(x, y), F.lit(False))), lambda x: x)


def markdown(header, rows) -> Column:
    """A table as lines of cells between bars; short rows are filled up, bars escaped."""
    header, rows = _col(header), _col(rows)
    every = F.concat(header, rows)
    width = F.coalesce(F.array_max(F.transform(every, F.size)), F.lit(0))
    cell = lambda x: F.replace(fields_joined(x), F.lit("|"), F.lit("\\|"))
    line = lambda r: F.concat(F.lit("|"), F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda i: F.concat(F.lit(" "), F.coalesce(cell(F.get(r, i)), F.lit("")), F.lit(" |"))), ""), F.lit("\n"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), width), F.lit("\n"))
    whole = F.concat(F.array_join(F.transform(header, line), ""), F.when(F.size(header) > 0, rule).otherwise(""), F.array_join(F.transform(rows, line), ""))
    return F.when(width == 0, F.lit("")).otherwise(whole)


def is_json(t) -> Column:
    """Whether a JSON value stands in front of a text; what follows it is not looked at."""
    t = _col(t)
    return F.when(t.rlike(JSON_AHEAD), F.try_parse_json(t).isNotNull()).otherwise(F.lit(False))


def extract_json(t) -> Column:
    """The JSON part of a model's answer: without a code fence, from the first bracket to its last partner."""

    def of(s: Column) -> Column:
        trailing = s.rlike(r"(?s)^[\[{].*[^\]}]\z")  # the parser stops at the end of the first value
        cut = F.regexp_extract(s, r"(?s)(\{.*\}|\[.*\])", 1)
        return F.when(is_json(s) & ~trailing, s).otherwise(F.nullif(cut, F.lit("")))

    unfenced = lambda s: trim_space(F.regexp_replace(F.regexp_replace(s, r"^```[^\n]*\n?", ""), r"(?s)```(?!.*```).*$", ""))
    return once(once(trim_space(t), lambda s: F.when(s.startswith("```"), unfenced(s)).otherwise(s)), of)


def paper_id(t) -> Column:
    """(id, version) of a paper number with optional prefix; NULL where malformed."""
    s = F.regexp_replace(trim_space(t), "^arXiv:", "")
    form = r"^(\d{4}\.\d{4,5})(v\d+)?\z"
    return F.when(s.rlike(form), F.struct(F.regexp_extract(s, form, 1).alias("id"), F.regexp_extract(s, form, 2).alias("version")))


def versioned_id(i, version) -> Column:
    return F.concat(_col(i), F.coalesce(_col(version), F.lit("")))


def record_name(url) -> Column:
    """A file name for a recorded response: path and query with other characters as single underscores."""
    s = F.regexp_replace(F.regexp_replace(_col(url), "^.*?://", ""), "^[^/]*/", "")
    s = F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9.-]+", "_"), "^_+|_+$", "")
    return F.concat(F.substring(s, 1, MAX_RECORD_NAME), F.lit(".json"))


def page_file_name(page) -> Column:
    return F.format_string("page-%04d.png", _col(page))


def page_number(name) -> Column:
    """The number in a page file's name, however wide."""
    return F.try_to_number(F.regexp_extract(_col(name), r"(\d+)\.png$", 1), F.lit("999999999")).cast("int")


def join_non_empty(*parts, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[F.nullif(_col(p), F.lit("")) for p in parts])


def in_page_order(names) -> Column:
    """File names by their page number, whatever their padding; names without one come last, by name."""
    keyed = F.transform(_col(names), lambda x: F.struct(page_number(x).isNull().alias("none"), page_number(x).alias("page"), x.alias("name")))
    return F.transform(F.array_sort(keyed), lambda x: x.getField("name"))


def first_non_empty(*parts) -> Column:
    return F.coalesce(*[F.nullif(_col(p), F.lit("")) for p in parts], F.lit(""))


def layout_tag(block_type) -> Column:
    return F.regexp_replace(_col(block_type), "^LAYOUT_", "")


def reason(*parts) -> Column:
    return join_non_empty(*parts, sep=": ")


def split_features(spec) -> Column:
    return F.filter(F.transform(F.split(_col(spec), ","), trim_space), lambda x: x != "")


def japanese_letters(t) -> Column:
    return F.regexp_count(_col(t), F.lit(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}&&\p{L}]"))


def latin_letters(t) -> Column:
    return F.regexp_count(_col(t), F.lit(r"[\p{IsLatin}&&\p{L}]"))


def detect_language(t, has_layer=True) -> Column:
    """(language, detected): "ja" from a tenth of Japanese letters on; too few letters, or no layer, is no decision."""
    ja, la = japanese_letters(t), latin_letters(t)
    enough = (ja + la >= LETTERS_NEEDED) & (F.lit(has_layer) if isinstance(has_layer, bool) else _col(has_layer))
    lang = F.when(enough & (ja / F.greatest(ja + la, F.lit(1)) >= JAPANESE_SHARE), "ja").otherwise("en")
    return F.struct(lang.alias("language"), F.coalesce(enough, F.lit(False)).alias("detected"))


def count_chars(t) -> Column:
    """Characters that are not white space."""
    return F.length(F.regexp_replace(_col(t), r"(?U)\s", ""))


def count_pages(t) -> Column:
    """Form feeds, one at least."""
    return F.greatest(F.regexp_count(_col(t), F.lit("\f")), F.lit(1))


def has_text_layer(chars, pages, least: int = MIN_CHARS_PER_PAGE) -> Column:
    return F.floor(_col(chars) / F.greatest(_col(pages), F.lit(1))) >= least


def count_references(t) -> Column:
    """The largest number in brackets at a line's start, below 10,000; 0 if none."""
    found = F.regexp_extract_all(_col(t), F.lit(REFERENCE_NUMBER), F.lit(1))
    return F.coalesce(F.array_max(F.filter(F.transform(found, lambda x: x.try_cast("int")), lambda x: x < MAX_REFERENCE_NUMBER)), F.lit(0))


def structure_prompt(pages, text) -> Column:
    """What a structuring model is asked for one document."""
    return F.format_string("Numbered layout elements of a paper of %d pages; tables are in markdown.\n\n%s", _col(pages), _col(text))


def page_prompt(page, language) -> Column:
    hint = F.when(F.coalesce(_col(language), F.lit("")) != "", F.concat(F.lit(" The language is "), _col(language), F.lit("."))).otherwise("")
    return F.concat(F.format_string("Page %d of a paper.", _col(page)), hint)


def directory_of(key) -> Column:
    return F.regexp_replace(_col(key), "[^/]+$", "")


def any_of(values: Iterable[str]) -> str:
    """Alternatives of a regular expression, literal."""
    import re

    return "|".join(re.escape(v) for v in values)
