"""Names and text: normal form, tokens, acronyms, glyph and line repair."""

from __future__ import annotations

import json
import unicodedata
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Accented Latin letters and their plain letter, by decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) for c in range(0xA0, 0x250)]
    kept = [(a, b) for a, b in pairs if len(b) == 1 and b.isalnum()]
    return "".join(a for a, _ in kept), "".join(b for _, b in kept)


_FROM, _TO = _accents()
ADDRESS = (
    r"^(SIM|NAO|N A|PENDENTE.*|TITULARES.*|CLASSE .*|QUIROGRAF.*|CREDORES.*|VALOR.*|TOTAL.*)$|"
    r"\b(AV|AVENIDA|RUA|ROD|RODOVIA|ALAMEDA|PRACA|PCA|QUADRA|SETOR|KM|CEP|ANDAR|SALA|CONJ|LOTE|BLOCO|ESTRADA|TRAVESSA|BAIRRO|"
    r"CIDADE|MUNICIPIO|FONE|TELEFONE|EMAIL|CNPJ|CPF|ENDERECO|VALOR|TOTAL|CLASSE|CREDOR|CREDORES)\b"
)
SMALL_WORDS = ("DE", "DA", "DO", "DAS", "DOS", "E", "EM")


def plain(x: Column) -> Column:
    """Accents dropped; what has no plain letter is left out."""
    t = F.coalesce(x, F.lit(""))
    # as many bytes as characters: nothing to drop
    return F.when(F.octet_length(t) == F.length(t), t).otherwise(F.regexp_replace(F.translate(t, _FROM, _TO), r"[^\x00-\x7F]", ""))


def unaccented(x: Column) -> Column:
    """Accented letters as their plain ones, all else as it is: every place keeps its character."""
    return F.translate(F.coalesce(x, F.lit("")), _FROM, _TO)


def wrapped(shape: str) -> str:
    """A pattern of a shape whose characters may stand apart, as where a line breaks.

    ``d`` is a digit, a blank any blanks, other characters are themselves.  Take
    the blanks out of a match to have it unwrapped.
    """
    atoms = {"d": "[0-9]", " ": r"\s"}
    escape = lambda c: c if c.isalnum() else "\\" + c
    return r"\s*".join(atoms.get(c, escape(c)) for c in shape)


def unwrapped(x: Column) -> Column:
    return F.regexp_replace(x, r"\s+", "")


def norm(x: Column) -> Column:
    """Plain upper case, runs of other characters as one blank."""
    return F.trim(F.regexp_replace(F.upper(plain(x)), "[^A-Z0-9]+", " "))


def lower_plain(x: Column) -> Column:
    return F.lower(plain(x))


def tokens(x: Column) -> Column:
    """Words of at least 3 letters (2 if one is a digit), not numbers."""
    word = lambda t: ((F.length(t) >= 3) | ((F.length(t) == 2) & t.rlike("[0-9]"))) & ~t.rlike("^[0-9]+$")
    return F.filter(F.split(norm(x), " "), word)


def is_name(x: Column) -> Column:
    p = norm(x)
    return (p != "") & ~p.rlike(ADDRESS) & (F.length(F.regexp_replace(p, "[^A-Z]", "")) >= 4) & (F.length(p) <= 90)


def acronym(x: Column) -> Column:
    words = F.filter(F.split(norm(x), " "), lambda w: ~w.isin(*SMALL_WORDS) & (w != ""))
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def initials(x: Column) -> Column:
    return F.array_join(F.filter(F.split(norm(x), " "), lambda w: F.length(w) == 1), "")


def dedouble(x: Column) -> Column:
    """Doubled glyphs of a bold print undone where half of the words have them."""
    # two doubled glyphs in a row are the least that a doubled word has
    suspect = x.rlike(r"(.)\1(.)\2")
    words = F.split(F.coalesce(x, F.lit("")), " ")
    doubled = lambda w: (F.length(w) >= 4) & w.rlike(r"^(?:(.)\1)+$")
    single = F.transform(words, lambda w: F.when(doubled(w), F.regexp_replace(w, r"(.)\1", "$1")).otherwise(w))
    return F.when(suspect & (2 * F.size(F.filter(words, doubled)) >= F.size(words)), F.array_join(single, " ")).otherwise(x)


def running_key(x: Column) -> Column:
    """A line's key across pages: digits as #, first 80 characters."""
    return F.left(F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), "[0-9]", "#"), F.lit(80))


def blanked(text: Column, noise: str) -> Column:
    """Lines that match ``noise`` turned to blanks of equal length."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_join(F.transform(lines, lambda s: F.when(s.rlike(noise), F.repeat(F.lit(" "), F.length(s))).otherwise(s)), "\n")


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word step per letter of ``b``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    free = full = (1 << len(a)) - 1
    for c in b:
        met = free & places.get(c, 0)
        free = ((free + met) | (free - met)) & full
    return len(a) - free.bit_count()


def likeness(a: str, b: str) -> float:
    """0 to 100: how much of both texts insertions and deletions leave standing."""
    size = len(a) + len(b)
    return 200.0 * common_length(a, b) / size if size else 100.0


def token_set_likeness(a: str, b: str) -> float:
    """Likeness of two names' word sets: the best of what both share against each
    side, and of the sides; 100 where one set holds the other."""
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    if one <= two or two <= one:
        return 100.0
    join = lambda words: " ".join(sorted(words))
    both = join(one & two)
    left, right = (f"{both} {join(x)}".strip() for x in (one - two, two - one))
    return max([likeness(left, right)] + ([likeness(both, left), likeness(both, right)] if both else []))


def partial_likeness(a: str, b: str) -> float:
    """Likeness of the shorter text to the best stretch of the longer one, cut-off
    stretches at both ends included."""
    short, long = sorted((a, b), key=len)
    n = len(short)
    if not n:
        return 100.0 if not long else 0.0
    stretches = {long[max(i, 0) : i + n] for i in range(1 - n, len(long))}
    best = max(likeness(short, x) for x in stretches)
    if n == len(long):
        best = max(best, *(likeness(long, short[max(i, 0) : i + n]) for i in range(1 - n, n)))
    return best


def _scored(score):
    """An Arrow-batched function of two string columns; nulls are empty texts."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([round(score(x or "", y or ""), 4) for x, y in zip(a, b, strict=True)])

    return run


def token_set_ratio(a: Column, b: Column) -> Column:
    """0-100 likeness of two names' word sets (see ``token_set_likeness``)."""
    return _scored(token_set_likeness)(norm(a), norm(b))


def partial_ratio(a: Column, b: Column) -> Column:
    """0-100 likeness of the shorter to a stretch of the longer (see ``partial_likeness``)."""
    return _scored(partial_likeness)(a, b)


_ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def unescaped(x: Column) -> Column:
    """Character references resolved: decimal, hexadecimal and the named ones of HTML 4.

    A name that is none stays as it is; a number that is no character becomes U+FFFD.
    """
    t = F.coalesce(x, F.lit(""))
    names = F.from_json(F.lit(json.dumps({k: chr(v) for k, v in name2codepoint.items()})), "map<string,string>")

    def resolved(e: Column) -> Column:
        hexed = F.when(e.rlike("^#[xX]"), F.substring(e, 3, 8)).otherwise(F.hex(F.substring(e, 2, 8).try_cast("int")))
        point = F.lpad(hexed, 8, "0")
        sound = (point > "00000000") & (point <= "0010FFFF") & ~point.between("0000D800", "0000DFFF")
        letter = F.when(sound, F.decode(F.unhex(F.when(sound, point)), "UTF-32")).otherwise("\ufffd")
        return F.when(e.startswith("#"), letter).otherwise(F.coalesce(F.try_element_at(names, e), F.concat(F.lit("&"), e, F.lit(";"))))

    found = F.transform(F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(1)), lambda e: resolved(F.when(e.startswith("#"), F.upper(e)).otherwise(e)))
    pairs = F.arrays_zip(F.split(t, _ENTITY, -1).alias("a"), found.alias("b"))
    return F.when(t.contains("&"), F.array_join(F.transform(pairs, lambda p: F.concat(p["a"], F.coalesce(p["b"], F.lit("")))), "")).otherwise(t)


def html_text(x: Column) -> Column:
    """Tags away, character references resolved, blanks squeezed."""
    t = unescaped(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?s)<[^>]+>", " "))
    return F.trim(F.regexp_replace(t, r"[\s\u00a0]+", " "))
