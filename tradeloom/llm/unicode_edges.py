"""Where the tokenizers library's Unicode tables are not those of Python.

The library composes by older tables than Python's, lower-cases by newer ones,
and its letters and numbers are fewer than those of the ``regex`` module.  The
ranges below are fixed values: they say how the library treats the code points
concerned.  A test compares all code points, alone and in company.
"""

from __future__ import annotations

import re
import unicodedata

#: Marks that the library does not reorder (and U+11930, which it does not compose).
PLAIN_MARKS = """
07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF
10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45
11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF
"""

#: Capitals that only the library lower-cases, and how far away their small letters are.
CAPITALS = {
    "1C89": 0x1,
    "A7CB": 0x264 - 0xA7CB,
    "A7CC": 0x1,
    "A7CE": 0x1,
    "A7D2": 0x1,
    "A7D4": 0x1,
    "A7DA": 0x1,
    "A7DC": 0x19B - 0xA7DC,
    "10D50-10D65": 0x20,
    "16EA0-16EB8": 0x1B,
}

#: Letters and numbers of the ``regex`` module that are neither in the library.
NEITHER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF
18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD
323B0-33479 3D000-3FC3F
"""


def ends(span: str) -> tuple[int, int]:
    first, _, last = span.partition("-")
    return int(first, 16), int(last or first, 16)


def char_class(spans) -> str:
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in map(ends, spans))


MARKS = re.compile(f"([{char_class(PLAIN_MARKS.split())}])")
SMALL = {c: c + step for span, step in CAPITALS.items() for a, b in [ends(span)] for c in range(a, b + 1)}
ODD = re.compile(f"[{char_class([*PLAIN_MARKS.split(), *CAPITALS])}]")
NO_LETTERS = re.compile(f"[{char_class(NEITHER.split())}]")


def latin(text: str) -> bool:
    """Whether all characters are below U+0100; much faster than a search."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def normalised(text: str) -> str:
    """NFC and lower case as the library has them; lower-casing is by character, so a final sigma gets no form of its own."""
    if not latin(text) and ODD.search(text):
        # A mark that is not reordered ends what can be composed, as a letter does.
        text = "".join(unicodedata.normalize("NFC", part) for part in MARKS.split(text)).translate(SMALL)
    else:
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()
