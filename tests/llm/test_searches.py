"""Winnowing, phrases and the prefix trie against plain versions, and against their SQL."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from tests.llm.cases import SCHEMA, documents
from wardflow.checks.compare import differences
from wardflow.llm import oracle, phrases, prefix_trie, queries, winnowing

SF_DIR = "/root/testdata/sf0.001"
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["op11_winnowing", "op12_phrases", "op13_prefix_trie"])
def test_query_equals_its_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF_DIR), SF_DIR, oracle.all_sql()[name]) is None


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


def test_winnowing_finds_every_window(spark, docs):
    texts = [t for _, t, *_ in documents() if t]
    words = lambda t: ITEM_WORD.findall(lowered(t))
    items = [
        (1, " ".join(texts[3].split()[5:40])), (2, texts[3]), (2, "TWO Words"), (3, "one"), (4, " - "), (5, None), (None, "echo echo echo"), (6, "echo " * 12),
        (7, "ÉCOLE endoftext Straße"), (8, " ".join(texts[8].split()[:9])), (9, "never seen words at all in any of these texts here"), (1, texts[0]),
    ]
    rows = winnowing.shared_passages(docs, spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, _text int")).collect()
    want = Counter()
    for doc_id, text, *_ in documents():
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            m = min(len(v), 10)
            spans = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in spans:
                    hit.update(range(i, i + m))
                    found.add("" if item_id is None else str(item_id))
        want[doc_id, len(w), tuple(sorted(hit)), tuple(sorted(found))] += 1
    got = Counter((r.doc_id, r.n_words, tuple(k for s in r.spans for k in range(s.begin, s.end)), tuple(r["items"])) for r in rows)
    assert got == want
    assert any(hit and found for _, _, hit, found in want)


def test_winnowing_of_nothing(spark, docs):
    items = spark.createDataFrame([(1, None), (2, "--")], "item_id long, text string")
    assert {(len(r.spans), len(r["items"])) for r in winnowing.shared_passages(docs, items).collect()} == {(0, 0)}
    assert winnowing.shared_passages(docs.limit(0), items).count() == 0
    assert winnowing.clean(docs, items).count() == docs.count()
    assert winnowing.clean(docs, spark.createDataFrame([(1, "echo " * 10)], "item_id long, text string")).count() == docs.count() - 1


def plain_collocations(given: list[tuple], least: int) -> dict:
    n, f = Counter(), defaultdict(Counter)
    for text, lang in given:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    told = {}
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        rows = []
        for p, a in often.items():
            inside = any(len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in often.items())
            if len(p) > 1 and not inside:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        told[lang] = [(p.decode(), -a, l, r, n[lang], -s) for s, a, p, l, r in sorted(rows)]
    return {lang: rows for lang, rows in told.items() if rows}


@pytest.mark.parametrize("shard_words", [50, 1 << 20])
def test_phrases_equal_plain_counts(docs, shard_words):
    given = [(t, lang) for _, t, lang, *_ in documents()]
    got = defaultdict(list)
    for r in phrases.collocations(docs, least=4, shard_words=shard_words).orderBy("lang", "rank").collect():
        got[r.lang].append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r.rank == len(got[r.lang]) and max(r.left, r.right) < r.a
    want = plain_collocations(given, 4)
    assert dict(got) == want and sum(map(len, want.values())) > 30


def test_phrases_of_nothing(docs):
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text IS NULL OR trim(text) = ''"), least=1).count() == 0


def plain_trie(paths: dict[int, list[tuple]]) -> set:
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    below = lambda node: [m for m in members if m[: len(node)] == node]
    children = lambda node: [m for m in members if len(m) == len(node) + 1 and m[:-1] == node]
    return {
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children(node)), sum(not children(b) for b in below(node)),
            sum((len(members[b]) - 1) * len(b[-1][1]) for b in below(node) if b), hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    }


def test_trie_equals_plain_prefixes(spark):
    rows = []
    for c in range(40):
        same = [("user", "hello"), ("assistant", "hi")] * (1 + c % 7)
        told = same if c % 3 else [*same[: c % 5], ("user", f"own {c % 6}"), ("assistant", None), (None, "é漢")]
        rows += [(c, t, role, text, "x") for t, (role, text) in enumerate(told)]
    rows += [(100, None, "user", "first"), (100, 1, "user", "first"), (100, 1, "user", "first"), (207, 3, "", ""), (None, 1, "user", "nobody"), (41, -5, "user", "x" * 50000)]
    rows += [(c, t, "user", "the same") for c in (60, 61, 62) for t in range(19)]
    rows = [(*r, "x")[:5] for r in rows]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string").repartition(5)
    folder = spark.conf.get("spark.checkpoint.dir") + "/trie-case"
    table.write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    own = defaultdict(list)
    for c, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if c is not None:
            own[c].append((role or "", text or ""))
    paths = {c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + t[zlib.crc32(str(c).encode()) % 6 :] for c, t in own.items()}
    got = queries.op13_prefix_trie(spark, folder).collect()
    want = plain_trie(paths)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_trie_of_long_copies_and_of_nothing(spark):
    turns = spark.createDataFrame([(c, p, "user", "ab") for c in range(3) for p in range(21)] + [(3, 0, "user", "other")], "conv_id long, pos long, role string, text string")
    ids = turns.select("conv_id").distinct()
    rows = {r.depth: r for r in prefix_trie.trie(turns.where("conv_id < 3"), ids.where("conv_id < 3")).collect()}
    assert rows[0].saved_tokens == 2 * 2 * 21 and rows[20].saved_tokens == 2 * 4 and {r.n_leaves for r in rows.values()} == {1} and len(rows) == 22
    root = next(r for r in prefix_trie.trie(turns, ids).collect() if r.depth == 0)
    assert (root.n_children, root.n_leaves, root.n_convs) == (2, 2, 4)
    assert prefix_trie.trie(turns.limit(0), ids.limit(0)).count() == 0
