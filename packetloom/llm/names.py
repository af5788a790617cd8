"""Names typed by people: parsing, sound-alike skeletons and Monge-Elkan similarity.

A name is a list of words without titles, quoted nicknames and marks; a name
written "family, given" is put back in order.  Two words are compared by the
edit distance of their skeletons, in which look-alike glyphs and sound-alike
letters coincide; an initial or a nickname of a word counts as a weaker match.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from packetloom.llm.canonical import damerau_levenshtein

#: Forms of address that are no part of a name; fixed values.
TITLES = {"mx", "mr", "ms", "mrs", "dr", "prof", "warden", "elder", "envoy", "sir", "rev", "captain", "capt"}
#: Endings of nicknames, longer ones first; fixed values.
NICK_ENDINGS = ("ie", "us", "i", "y", "a", "o", "u")
_LOOKS = str.maketrans({"0": "o", "1": "l", "!": "i", "|": "l", "5": "s", "$": "s", "@": "a", "9": "g", "6": "b", "8": "b"})
#: Letters that sound alike, longer groups first; fixed values.
_SOUNDS = (("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"), ("ph", "f"), ("x", "ks"), ("qu", "kw"), ("q", "k"), ("c", "k"), ("w", "v"), ("y", "i"), ("z", "s"), ("l", "i"))
MATCH, WEAK = 0.7, 0.8


def words_of(name: str | None) -> tuple[str, ...]:
    """The words of a name in the order given names, family name."""
    if not name:
        return ()
    text = unicodedata.normalize("NFKD", name)
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    text = re.sub(r"[\"“”(][^\"“”)]*[\"“”)]", " ", text)
    head, comma, tail = text.partition(",")
    if comma and tail.strip():
        text = f"{tail} {head}"
    text = re.sub(r"['’`‐-―-]", "", text).translate(_LOOKS)
    words = re.findall(r"[a-z]+", text)
    kept = [w for w in words if w not in TITLES]
    return tuple(kept or words)


@lru_cache(100_000)
def skeleton(word: str) -> str:
    for a, b in _SOUNDS:
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


def _initials_agree(a: str, b: str) -> bool:
    return a[0] == b[0] or skeleton(a)[:1] == skeleton(b)[:1]


def _nickname(short: str, full: str) -> bool:
    if len(short) >= len(full) or len(short) > 6:
        return False
    plain = re.sub(r"(.)\1+", r"\1", short)
    for stem in (plain, *(plain[: -len(e)] for e in NICK_ENDINGS if plain.endswith(e))):
        if len(stem) >= 2 and (full.startswith(stem) or (len(stem) >= 3 and skeleton(full).startswith(skeleton(stem)))):
            return True
    return False


@lru_cache(200_000)
def word_similarity(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return WEAK if _initials_agree(a, b) else 0.0
    s, t = skeleton(a), skeleton(b)
    close = 1 - damerau_levenshtein(s, t) / max(len(s), len(t))
    if close >= MATCH:
        return close
    return WEAK if _nickname(a, b) or _nickname(b, a) else 0.0


def _readings(words: tuple[str, ...]) -> list[tuple[str, ...]]:
    """The words, and the words with one neighbouring pair written together."""
    out = [words]
    if len(words) > 2:
        out += [(*words[:i], words[i] + words[i + 1], *words[i + 2 :]) for i in range(len(words) - 1)]
    return out


def _paired(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    best = 0.0
    for i in {0, len(a) - 1}:
        for j in {0, len(b) - 1}:
            if min(len(a[i]), len(b[j])) < 4:
                continue
            family = word_similarity(a[i], b[j])
            if family < MATCH or min(len(a[i]), len(b[j])) <= 4 and family < 0.9:
                continue
            rest_a, rest_b = a[:i] + a[i + 1 :], b[:j] + b[j + 1 :]
            given = [word_similarity(x, y) for x, y in zip(rest_a, rest_b, strict=False)]
            if given and min(given) >= MATCH:
                best = max(best, (family + sum(given)) / (1 + len(given)))
    return best


@lru_cache(200_000)
def name_similarity(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Monge-Elkan mean of the best word matches, 0 when the names cannot be one person's.

    One long word (the family name) must match well; the remaining words must
    match in order as far as both names have them, so a left-out middle name is
    no objection and a different given name is.  Names of one word match only
    when they are equal.
    """
    if a == b:
        return 1.0 if a else 0.0
    if len(a) < 2 or len(b) < 2:
        return 0.0
    best = 0.0
    for x in _readings(a):
        for y in _readings(b):
            if len(x) >= 2 and len(y) >= 2:
                best = max(best, _paired(x, y))
    return best
