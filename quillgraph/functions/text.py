"""Text functions."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What Windows-1252 shows for a byte; the five bytes that it lacks stand for themselves, and so do C1 controls of texts read as Latin-1.
_SHOWN = {b: bytes([b]).decode("cp1252", "replace").replace("�", chr(b)) for b in range(0x80, 0x100)}
_BYTE = {chr(b): b for b in range(0x80, 0x100)} | {c: b for b, c in _SHOWN.items()}
_NEXT = "".join(sorted({re.escape(c) for b in range(0x80, 0xC0) for c in (chr(b), _SHOWN[b])}))
#: Marks that may well stand behind a capital letter.
_MARKS = "‘’“”»–—"
_ONE = "".join(sorted({re.escape(c) for b in range(0x80, 0xC0) for c in (chr(b), _SHOWN[b]) if c not in _MARKS}))
_MOJIBAKE = re.compile(f"[ÂÃ][{_NEXT}]|Å“|Æ’|(?:[Ä-ß][{_NEXT}]){{2,}}|[Ä-Þ][{_ONE}]|[à-ï][{_NEXT}]{{2}}|[ð-ô][{_NEXT}]{{3}}")
_ROUNDS = 4

_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][0-9A-Za-z]{0,31});")
_ESCAPE = re.compile("\x1b\\[[0-9;]*[A-Za-z]")
_LIGATURES = {"Ĳ": "IJ", "ĳ": "ij", "ŉ": "ʼn", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz"}
_PLAIN = (
    _LIGATURES
    | {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in [*range(0xFB00, 0xFB07), *range(0xFF01, 0xFFF0)]}
    | {"　": " "}
    | dict.fromkeys("ʼ‘’‚‛", "'")
    | dict.fromkeys("“”„‟", '"')
    | dict.fromkeys("\r  \x85", "\n")
    | {chr(c): None for c in [*range(0x00, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, *range(0x206A, 0x2070), 0xFEFF, *range(0xFFF9, 0xFFFD)]}
)
_PLAIN = str.maketrans(_PLAIN)
_CHARACTERS = _PLAIN | {b: _SHOWN[b].translate(_PLAIN) for b in range(0x80, 0xA0) if b != 0x85}
_NOT_PLAIN = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_CHARACTERS)) + "]")


def _decoded(found: re.Match) -> str:
    try:
        return bytes(map(_BYTE.__getitem__, found[0])).decode()
    except UnicodeDecodeError:
        return found[0]


def decode_again(text: str) -> str:
    """UTF-8 that was read as Windows-1252 or Latin-1, once or several times, is put right where the characters can hardly be anything else: sequences of three and four bytes,
    of several pairs, pairs that begin with Â or Ã, and single other pairs unless the second is a mark that often stands behind a capital (but œ and ƒ)."""
    for _ in range(0 if text.isascii() else _ROUNDS):
        new = _MOJIBAKE.sub(_decoded, text)
        if new == text:
            break
        text = new
    return text


def _entity(found: re.Match) -> str:
    return html.unescape(found[0]) if found[0][1] == "#" else html5.get(found[0][1:], found[0])


def resolve(text: str) -> str:
    """Entities, once. One without its semicolon is no entity: a text may be cut off, and ``?a=1&copy=2`` means what it says."""
    return _ENTITY.sub(_entity, text)


def repair(text: str) -> str:
    """Entities that were escaped twice (in a text without tags), terminal escapes, broken encoding, C1 controls, ligatures, wide forms, curly quotes, line ends,
    and control characters."""
    if "<" not in text:
        text = resolve(text)
    text = decode_again(_ESCAPE.sub("", text)).replace("\r\n", "\n")
    return text.translate(_CHARACTERS) if _NOT_PLAIN.search(text) else text


def clean(text: str | None) -> str | None:
    """Entities resolved, broken text repaired, composed form, white space at the ends gone."""
    return None if text is None else unicodedata.normalize("NFC", repair(resolve(text))).strip()


@F.pandas_udf(StringType())
def _clean_udf(texts: pd.Series) -> pd.Series:
    return texts.map(clean, na_action="ignore")


def clean_text(text: Column | str) -> Column:
    """clean() as a column. A text of printable ASCII without & and without white space at its ends is as it should be and doesn't reach Python."""
    text = F.col(text) if isinstance(text, str) else text
    odd = text.rlike(r"[^\x20-\x25\x27-\x7e\n\t]|\A\s|\s\z")
    return F.when(odd, _clean_udf(F.when(odd, text))).otherwise(text)


def invert_abstract(index: Column | str) -> Column:
    """The abstract's words by position, joined by a space; gaps close; of words at one position the first one in the map stays; '' for NULL or no positions.

    All in built-in functions: entries become (position, place of the word in the map, word), are sorted, and each is put beside the one before it, so that repeats of a
    position go. Not yet cleaned.
    """
    index = F.col(index) if isinstance(index, str) else index
    entries = F.transform(
        F.map_entries(index),
        lambda e, at: F.transform(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("p"), at.alias("at"), e["key"].alias("w"))),
    )
    placed = F.array_sort(F.flatten(entries))
    before = F.concat(F.array(F.lit(None).cast("struct<p:int,at:int,w:string>")), placed)
    words = F.zip_with(placed, before, lambda e, b: F.when(e["p"].isNotNull() & ~e["p"].eqNullSafe(b["p"]), e["w"]))
    return F.coalesce(F.array_join(words, " "), F.lit(""))
