"""Small documents with every awkward case, and plain versions to compare with."""

from __future__ import annotations

import random
import re
from itertools import combinations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines string, copies string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int, words: str) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words.split()) + (".\n" if k % 11 == 10 else "") for k in range(n)).replace("\n ", "\n")


ENGLISH = "the of and to in that is was for it with as his on be at by had not are but from or have an they which you were her all she there would their"
GERMAN = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei"


def documents() -> list[tuple]:
    rows = []
    for k in range(24):
        lang = "en" if k % 2 else "de"
        rows.append((k, prose(k, 60 + 7 * k, ENGLISH if lang == "en" else GERMAN), lang, f"src{k % 3}"))
    long_line = prose(99, 70, ENGLISH).replace("\n", " ")
    rows += [
        (100, None, "en", "src0"), (101, "", "de", None), (102, " \n\t ", None, "src1"), (103, "one", "en", "src1"), (104, "two words", None, None),
        (105, rows[5][1], "en", "src2"), (106, rows[5][1] + " tail", "en", "src2"), (106, rows[5][1] + " tail", "en", "src2"), (107, "123 456 !!", "en", "src0"),
        (108, f"start\n{long_line}\nmiddle words", "en", "src0"), (109, f"other\n\n{long_line}\nend", "en", "src0"), (110, f"{long_line}\n{long_line}", "en", "src9"),
        (111, "echo " * 6000, "en", "src0"), (112, "x" * 5000, "en", "src1"), (None, prose(7, 40, GERMAN), "de", "src1"),
        (113, prose(13, 700, ENGLISH) + "\n" + prose(14, 30, GERMAN), "en", "src1"), (114, "ÉCOLE <|endoftext|> Straße naïve 漢字 don't", "fr", "src1"),
    ]
    return [(i, t, lang, source, None, 0.5, "clash", "clash") for i, t, lang, source in rows]


def tokens(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text: str | None, size: int) -> frozenset:
    w = tokens(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def linked(sets: list[frozenset], percent: int) -> list[int]:
    """The component (smallest position) of every set, by comparing all pairs."""
    parent = list(range(len(sets)))

    def root(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [root(k) for k in range(len(sets))]


def repeats(docs: list[tuple], min_words: int) -> dict:
    """Positions, among lines with a word, of later copies of long enough runs."""
    first, gone = set(), {}
    for key, text in docs:
        lines = [x for x in text.split("\n") if WORD.search(x)]
        gone[key] = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += len(WORD.findall(lines[b]))
                if n >= min_words:
                    run = tuple(lines[a : b + 1])
                    if run in first:
                        gone[key].update(range(a, b + 1))
                    first.add(run)
    return gone
