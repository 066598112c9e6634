"""Text normalisation of names and addresses as Column expressions.

Every function takes and returns Columns, so that Catalyst sees one projection.  Missing values
are empty strings.  ``country`` changes a rule only for ``france`` and ``india``.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes, trailing (current rules), anywhere (older rules) and in profiles.
SUFFIXES = (
    "incorporated inc corporation corp company co limited ltd llc llp lp private pvt sarl sas eurl sa sci sasu snc pty gmbh plc bv nv ag"
).split()
SUFFIXES_OLD = (
    "incorporated inc corporation corp company co limited ltd llc llp lp private pvt sarl sas sa eurl pty gmbh plc"
).split()
SUFFIXES_PROFILE = (
    "inc incorporated llc corp corporation ltd limited pvt private co company llp plc gmbh sarl sas sa eurl sci "
    "associates group services solutions enterprises holdings"
).split()
SUFFIX_PAIRS_PROFILE = ["pvt ltd", "private limited"]
SUFFIX_INVENTORY = "inc llc corp corporation ltd limited pvt llp plc sarl sas sa eurl sci co associates group".split()
SUFFIXES_FRENCH = "sarl sas sa eurl sci snc scop gie selarl sasu".split()

# Top-level domains and honorifics that are cut from names.
DOMAINS = r"com|net|org|info|biz|io|co\.in|co\.uk|in|us|fr|edu|gov"
HONORIFICS = r"[-–—]+\s*|m/s\.?\s+|mr\.?\s+|mrs\.?\s+|ms\.?\s+|dr\.?\s+"

# Words of addresses.
LANDMARKS = r"near|nr|opp\.?|opposite|behind|beside|next\s+to|adjacent\s+to"
LANDMARKS_PROFILE = "near opp opposite behind beside adjacent".split()
ABBREVIATIONS = {
    "rd": "road", "ave": "avenue", "blvd": "boulevard", "apt": "apartment", "fl": "floor",
    "ste": "suite", "nr": "near", "hwy": "highway", "ln": "lane",
}
ABBREVIATIONS_ENGLISH = {"st": "street", "no": "number"}
ABBREVIATIONS_OLD = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "apt": "apartment",
    "fl": "floor", "ste": "suite", "no": "number", "nr": "near",
}
STREETS = {
    "st": "street", "ave": "avenue", "rd": "road", "dr": "drive", "blvd": "boulevard", "ln": "lane", "ct": "court",
    "pl": "place", "pkwy": "parkway", "cir": "circle", "hwy": "highway", "fwy": "freeway", "sq": "square",
    "ste": "suite", "apt": "apartment", "fl": "floor", "bldg": "building", "dept": "department",
}
STREETS_FRENCH = (
    "rue avenue ave av boulevard bd bld place pl chemin ch route rte impasse imp allée allee cours quai square passage zone zi za zac"
).split()
# Postal codes of profiles, by country.
POSTAL_US = r"\p{Nd}{5}(?:-\p{Nd}{4})?"
POSTAL_INDIA = r"[1-9]\p{Nd}{5}"
POSTAL_FRANCE = r"(?:0[1-9]|[1-8]\p{Nd}|9[0-8])\p{Nd}{3}"

WORD = r"[\p{L}\p{N}_]"
_BEFORE, _AFTER = rf"(?<!{WORD})", rf"(?!{WORD})"
#: What counts as white space, and what is neither word nor white space.
SPACE = r"[\s\p{Z}\x85\x1c-\x1f]"
PUNCTUATION = r"[^\p{L}\p{N}_\s\p{Z}\x85\x1c-\x1f]"


def whole(pattern: str) -> str:
    """pattern where no word character stands on either side."""
    return f"{_BEFORE}(?:{pattern}){_AFTER}"


def whole_literal(text: str) -> str:
    """``whole`` for letters alone, which come first in the pattern: most places then fail at one character."""
    return f"{text}(?<!{WORD}{text}){_AFTER}"


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, str]:
    """From the Unicode data: characters that fold to one other, those others, and a class of the marks that go."""
    source, target, marks = [], [], []
    for point in range(0x80, 0x10000):
        ch = chr(point)
        if 0xD800 <= point < 0xE000:
            continue
        if unicodedata.combining(ch):
            marks.append(point)
            continue
        flat = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(flat) == 1 and flat != ch:
            source.append(ch)
            target.append(flat)
    runs: list[list[int]] = []
    for point in marks:
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "".join(source), "".join(target), "[[^\\x00-\\x7f]&&[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]]"


def fold_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks, for characters that decompose to one base.

    ``fold_accents_exact`` also covers ligatures and the like.
    """
    source, target, marks = _folds()
    return F.regexp_replace(F.translate(c, source, target), marks, "")


def fold_accents_exact(c: Column) -> Column:
    """NFKD without combining marks, by an Arrow UDF: for texts with multi-character decompositions."""
    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        def one(t):
            if t is None or t.isascii():
                return t
            return "".join(ch for ch in unicodedata.normalize("NFKD", t) if not unicodedata.combining(ch))

        return s.map(one)

    return fold(c)


def squeeze(c: Column) -> Column:
    # Single blanks stay as they are, which spares a replacement for each word.
    return F.trim(F.regexp_replace(c, rf"{SPACE}{{2,}}|[{SPACE}&&[^ ]]", " "))


def plain(c: Column) -> Column:
    """Punctuation to spaces, white space squeezed."""
    return squeeze(F.regexp_replace(c, PUNCTUATION, " "))


def is_country(country: Column, name: str) -> Column:
    return F.lower(F.trim(F.coalesce(country, F.lit("")))) == name


def _saint(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_BEFORE}st\.?(?={PUNCTUATION}|{SPACE}|$)", "saint")


def words(c: Column) -> Column:
    """The words between single spaces; none for an empty text."""
    return F.array_remove(F.split(c, " "), "")


def word_runs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"{WORD}+"), F.lit(0))


def strip_trailing_suffixes(c: Column, most: int = 4) -> Column:
    """Drops up to four trailing legal suffixes of squeezed text, never the last word."""
    return F.regexp_replace(c, rf"(?<=.)(?: (?:{'|'.join(SUFFIXES)})){{1,{most}}}$", "")


def normalize_name(name: Column, country: Column) -> Column:
    c = F.coalesce(name, F.lit(""))
    c = F.regexp_replace(c, rf"(?i)^{SPACE}*(?:{HONORIFICS})+", " ")
    c = F.regexp_replace(c, rf"(?i)\.(?:{DOMAINS}){_AFTER}", " ")
    c = F.replace(F.lower(fold_accents(c)), F.lit("&"), F.lit(" and "))
    c = F.when(is_country(country, "france"), _saint(c)).otherwise(c)
    return strip_trailing_suffixes(plain(c))


def normalize_name_old(name: Column) -> Column:
    c = F.replace(F.lower(fold_accents(F.coalesce(name, F.lit("")))), F.lit("&"), F.lit(" and "))
    # An optional dot belongs to the suffix only if a word follows it at once.
    c = F.regexp_replace(c, rf"{_BEFORE}(?:{'|'.join(SUFFIXES_OLD)})(?:\.(?={WORD})|{_AFTER})", " ")
    return plain(c)


def normalize_address(address: Column, country: Column) -> Column:
    c = F.coalesce(address, F.lit(""))
    c = F.lower(F.when(c.rlike(r"[^\x00-\x7f]"), fold_accents(c)).otherwise(c))
    c = F.regexp_replace(c, rf"(?=[nobas]){_BEFORE}(?:near|nr|opp(?:\.(?={WORD}))?|opposite|behind|beside|next{SPACE}+to|adjacent{SPACE}+to)(?:{_AFTER}|(?<=\.))", " ")
    for short, long in ABBREVIATIONS.items():
        c = F.regexp_replace(c, whole_literal(short), long)
    english = c
    for short, long in ABBREVIATIONS_ENGLISH.items():
        english = F.regexp_replace(english, whole_literal(short), long)
    return plain(F.when(is_country(country, "france"), _saint(c)).otherwise(english))


def normalize_address_old(address: Column) -> Column:
    c = F.regexp_replace(F.lower(fold_accents(F.coalesce(address, F.lit("")))), PUNCTUATION, " ")
    for short, long in ABBREVIATIONS_OLD.items():
        c = F.regexp_replace(c, whole(short), long)
    return squeeze(c)


def strip_suffix_profile(name: Column) -> Column:
    """Drops a trailing pair or word of the profile list once; names without words come back lowered."""
    low = F.trim(F.lower(name))
    found = word_runs(low)
    n = F.size(found)
    pair = F.concat_ws(" ", F.try_element_at(found, F.lit(-2)), F.try_element_at(found, F.lit(-1)))
    return (
        F.when((n >= 2) & pair.isin(*SUFFIX_PAIRS_PROFILE), F.array_join(F.slice(found, 1, F.greatest(n - 2, F.lit(0))), " "))
        .when((n >= 1) & F.try_element_at(found, F.lit(-1)).isin(*SUFFIXES_PROFILE), F.array_join(F.slice(found, 1, F.greatest(n - 1, F.lit(0))), " "))
        .otherwise(low)
    )


def expand_streets(text: Column) -> Column:
    names = F.create_map(*(F.lit(x) for kv in STREETS.items() for x in kv))
    return F.array_join(F.transform(word_runs(F.lower(text)), lambda w: F.coalesce(F.try_element_at(names, w), w)), " ")


def despace(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def digit_runs(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\p{Nd}+"), F.lit(0)))


def postal_code(address: Column, country: Column) -> Column:
    """The trailing postal code; in France also five digits before a word; none in India."""
    c = F.coalesce(address, F.lit(""))
    end = F.regexp_extract(F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", ""), rf"{_BEFORE}(\p{{Nd}}{{5}}(?:-\p{{Nd}}{{4}})?)$", 1)
    inner = F.regexp_extract(c, rf"{_BEFORE}(\p{{Nd}}{{5}})(?={SPACE}+[A-Za-z])", 1)
    return F.when(is_country(country, "india"), "").when(end != "", end).when(is_country(country, "france"), inner).otherwise("")


def postal_code_old(address: Column) -> Column:
    return F.regexp_extract(F.coalesce(address, F.lit("")), rf"{_BEFORE}(\p{{Nd}}{{5,6}}(?:[-\s]\p{{Nd}}{{3,4}})?){_AFTER}", 1)


def postal_code_profile(address: Column, country: Column) -> Column:
    """The last postal code by the country's pattern, or the empty text."""
    c = F.coalesce(address, F.lit(""))
    last = lambda p: F.coalesce(F.try_element_at(F.regexp_extract_all(c, F.lit(whole(p)), F.lit(0)), F.lit(-1)), F.lit(""))
    us = F.regexp_extract(last(POSTAL_US), r"^\p{Nd}{5}", 0)
    return F.when(country == "US", us).when(country == "India", last(POSTAL_INDIA)).when(country == "France", last(POSTAL_FRANCE)).otherwise("")


def char_ngrams(c: Column, n: int = 3) -> Column:
    """The set of n-grams; a shorter text is its only one."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substr(c, i, F.lit(n)))
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def char_ngram_bag(c: Column, low: int = 3, high: int = 5) -> Column:
    """All n-grams of sizes low..high with repeats; sizes over the length give none."""
    bags = []
    for n in range(low, high + 1):
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i, n=n: i)
        bags.append(
            F.when(F.length(c) >= n, F.transform(grams, _gram(c, n))).otherwise(F.array().cast("array<string>"))
        )
    return F.concat(*bags)


def _gram(c: Column, n: int):
    return lambda i: F.substr(c, i, F.lit(n))


def has_non_latin(c: Column) -> Column:
    """Whether a letter lies at U+0900 or above."""
    return c.rlike(r"[\p{L}&&[^\x{0000}-\x{08FF}]]")


def count_matching(c: Column, pattern: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


@lru_cache(maxsize=1)
def _decomposing() -> str:
    """A class of the characters that have a decomposition, from the Unicode data."""
    runs: list[list[int]] = []
    for point in range(0x80, 0x10000):
        if not 0xD800 <= point < 0xE000 and unicodedata.decomposition(chr(point)):
            if runs and runs[-1][1] == point - 1:
                runs[-1][1] = point
            else:
                runs.append([point, point])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


def non_ascii(c: Column) -> Column:
    return count_matching(c, r"[^\x00-\x7F]")


def accented(c: Column) -> Column:
    return count_matching(c, _decomposing())


def non_latin(c: Column) -> Column:
    """Letters and marks outside ASCII that are not Latin."""
    return count_matching(c, r"[[\p{L}\p{M}]&&[^\x00-\x7F]&&[^\p{IsLatin}]]")


def source_tag(entity_id: Column) -> Column:
    return F.split_part(entity_id, F.lit("-"), F.lit(1))


def channel_text(channel: str, name: Column, address: Column) -> Column:
    if channel == "name":
        return name
    if channel == "address":
        return address
    if channel == "combo":
        return F.trim(F.concat_ws(" ", name, address))
    raise ValueError(f"unknown channel {channel}")
