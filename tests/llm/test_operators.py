"""Every operator against a plain version on small documents with every awkward case."""

from __future__ import annotations

import gc
import hashlib
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ENGLISH, GERMAN, SCHEMA, documents, linked, prose, repeats, shingles, tokens
from wardflow.llm import bit_mixing, langid, line_runs, merkle, mixture, packing, quality, reply_trees, revisits, shingle_join
from wardflow.llm.common import remainder


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_scores_add_up_and_base_is_exact(docs):
    rows = bit_mixing.score_texts(docs, remainder(F.col("doc_id"), 5) != 1).collect()
    learned = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1
    counts = Counter(w for i, t, *_ in documents() if learned(i) for w in [*tokens(t), None])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, *_ in documents():
        w = [*tokens(t), None]
        base = sum(np.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[i, learned(i), len(w), sum(counts[x] > 0 for x in w), round(base, 5)] += 1
    assert Counter((r.doc_id, r.learned, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 for r in rows)


def test_bit_probabilities_of_all_next_bytes_sum_to_one():
    code = bit_mixing.prefix_code(np.arange(256))
    model = bit_mixing.fresh(bit_mixing.Model([], code, 16, np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)))
    rng = np.random.default_rng(1)
    model.zeros[:], model.ones[:] = rng.integers(0, 40, (2, 1 << 16))
    words, gate = [bytes([b]) for b in range(256)], np.zeros(256, np.int64)
    with np.errstate(over="ignore"):
        logs = bit_mixing.log10_of(bit_mixing.spell(words, gate), gate, 256, model)
    assert abs((10**logs).sum() - 1) < 1e-6


def test_scores_do_not_depend_on_partitions(spark, docs):
    learn = remainder(F.col("doc_id"), 5) != 1
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.base_score, r.score)
    one = sorted(bit_mixing.score_texts(docs, learn).collect(), key=key)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        two = sorted(bit_mixing.score_texts(docs.repartition(7), learn).collect(), key=key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [(r.doc_id, r.n_tokens, r.n_bytes) for r in one] == [(r.doc_id, r.n_tokens, r.n_bytes) for r in two]
    assert np.allclose([r.score for r in one], [r.score for r in two], rtol=1e-6)
    sizes = Counter((i, sum(len(w.encode()) + 1 for w in tokens(t)) + 1) for i, t, *_ in documents())
    assert Counter((r.doc_id, r.n_bytes) for r in one) == sizes


def test_contexts_equal_plain_prefixes_and_long_words_are_quick():
    """Two bytes share a whole-word context exactly if what stands before them is the same."""
    words = [b"there ", b"therein ", b"the ", b"here ", b"there ", bytes([97]) * 200_000 + b" "]
    with np.errstate(over="ignore"):
        text = bit_mixing.spell(words, np.zeros(len(words), np.int64))
    assert len(text.byte) == sum(map(len, words))
    short = np.flatnonzero(text.owner < 5)
    prefixes = [words[o][:k] for o, k in zip(text.owner[short], text.place[short], strict=True)]
    names = {}
    for prefix, context in zip(prefixes, text.contexts[3][short].tolist(), strict=True):
        assert names.setdefault(prefix, context) == context
    assert len(set(names.values())) == len(names)
    assert len(np.unique(text.contexts[3][text.owner == 5])) == 200_001


def test_scores_return_to_their_blocks_without_a_join_by_word(docs):
    scored = bit_mixing.score_texts(docs, remainder(F.col("doc_id"), 5) != 1)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan and "Generate" not in plan


def test_packed_words_come_back_and_buckets_follow_the_word():
    words, n_gates = pa.array(["\n", "a", "\u00e4\u00df", "b" * 300]), np.array([1, 2, 1, 3])
    gates, learned = np.array([0, 0, 15, 3, 1, 2, 9]), np.array([5, 0, 70_000, 1, 1 << 40, 2, 3])
    rows = pa.table(bit_mixing.packed_words(words, np.array([0, 1, 4]), n_gates, gates, learned))
    texts, *numbers, n_pairs = bit_mixing.unpacked_words(rows)
    assert texts.to_pylist() == words.to_pylist() and n_pairs.tolist() == [1, 6]
    assert [x.tolist() for x in numbers] == [n_gates.tolist(), gates.tolist(), learned.tolist()]
    counts = np.array([0, 1, 2, 70_000, 3, 0, 0, 1], np.uint64)
    assert bit_mixing.unpacked_counts(bit_mixing.packed_counts(counts)).tolist() == counts.tolist()
    own = bit_mixing.dealt(words, 1000)
    assert own.tolist() == [bit_mixing.dealt(words.slice(k, 1), 1000)[0] for k in range(4)] and len(set(own)) == 4


def test_shingle_join_equals_all_pairs(docs):
    rows = shingle_join.similar_sets(docs, 4, 85).collect()
    given = documents()
    sets = [shingles(t, 4) for _, t, *_ in given]
    group = linked(sets, 85)
    name = {g: min((given[k][0] for k in range(len(given)) if group[k] == g and given[k][0] is not None), default=None) for g in set(group)}
    want = Counter((given[k][0], len(sets[k]), name[group[k]] if sets[k] else given[k][0]) for k in range(len(given)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want


def test_near_copies_of_frequent_shingles_are_found_in_pairs():
    """Sets of frequent tokens only still share a key whenever they are similar."""
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    for n in (6, 7, 20, 90, 300):
        for _ in range(30):
            x = np.sort(rng.choice(pool, n, replace=False))
            y = np.sort(np.concatenate([rng.choice(x, n - n // 14, replace=False), rng.choice(pool, n // 14)]))
            y = np.unique(y)
            both = len(np.intersect1d(x, y))
            some = rng.random(len(pool)) < 0.7
            frequent = lambda s: shingle_join.is_frequent(s, pool[some])
            if 100 * both >= 85 * (len(x) + len(y) - both) and not np.array_equal(x, y):
                assert len(np.intersect1d(shingle_join.signatures(x, frequent(x), 85), shingle_join.signatures(y, frequent(y), 85)))


def test_sketches_never_differ_by_more_than_the_sets():
    """So no similar pair is sifted out, whatever the sizes; unlike sets are told apart."""
    rng = np.random.default_rng(5)
    for n, other in ((1, 1), (3, 200), (64, 65), (128, 130), (500, 520), (1000, 1030), (5000, 5100)):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for kept in (0, n // 2, n - n // 10, n):
            y = np.unique(np.concatenate([x[:kept], rng.integers(0, 2**63, other - kept).astype(np.uint64)]))
            apart, truth = shingle_join.sketch_distance(shingle_join.sketch_of(x), shingle_join.sketch_of(y)), len(np.setxor1d(x, y))
            assert apart == shingle_join.sketch_distance(shingle_join.sketch_of(y), shingle_join.sketch_of(x)) <= truth
            if kept == 0 and n >= 64:
                assert 185 * apart > 15 * (len(x) + len(y))
    assert shingle_join.sketch_distance(shingle_join.sketch_of(x), shingle_join.sketch_of(x)) == 0


def test_words_encoded_together_have_their_own_ids():
    """Plain words as one text, odd ones alone, and what a full memory forgets."""
    ids = packing.WordIds(packing.default_tokenizer())
    given = ["plain", "Words,", "x²", "İstanbul", "it's", "<|endoftext|>", "a.b", "…", "漢字", "ﬁ", "é", "e\u0301", "one.", "१२", "ΑΣ"]
    for words in (given, given[::-1], ["new", *given]):
        pool, first, n = ids.of(pa.array(words))
        assert [pool[a : a + k].tolist() for a, k in zip(first, n, strict=True)] == [ids.tokenizer.encode(w, add_special_tokens=False).ids for w in words]


def test_word_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    ids = packing.WordIds(packing.default_tokenizer())
    for words in (["a", "b", "c"], ["b", "d", "e", "f"], ["f", "a"]):
        pool, first, n = ids.of(pa.array(words))
        assert [pool[a : a + k].tolist() for a, k in zip(first, n, strict=True)] == [ids.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert len(ids.slots) <= 5


def test_quality_counts_and_verdicts(docs):
    given = defaultdict(list)
    for i, t, *_ in documents():
        w = __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")
        seen, inside = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7)), set()
        for k in range(len(w) - 7):
            if seen[tuple(w[k : k + 8])] > 1:
                inside.update(range(k, k + 8))
        lines = [x for x in (t or "").split("\n") if tokens(x)]
        given[i].append((len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)))
    rows = quality.judge(docs).collect()
    assert len(rows) == len(documents())
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in given[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert {r.doc_id for r in rows if r.kept} >= set(range(24))


def test_quality_verdict_depends_on_the_source(spark):
    """The same text falls where marks are rare and stays where they are common; a source of
    two documents is judged by its language."""
    body = [f"word{i}" for i in range(200)]
    marked = " ".join(w + "##" if i % 2 else w for i, w in enumerate(body))
    some = [" ".join(w + "##" if i % (2 + k % 7) == 0 else w for i, w in enumerate(body)) for k in range(400)]
    rows = [(k, "en", "markup", some[k]) for k in range(400)] + [(1000 + k, "en", "prose", " ".join(body[k % 50 :])) for k in range(1200)]
    rows += [(5000, "en", "markup", marked), (5001, "en", "prose", marked), (5002, "en", "tiny", marked), (5003, "en", "tiny", " ".join(body))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    told = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert [told[k].kept for k in (5000, 5001, 5003)] == [True, False, True]
    assert told[5001].failed_measures.startswith("symbols_per_char") and all(r.kept for k, r in told.items() if k < 5000)
    limits = {r.source: r.symbols_per_char.high for r in quality.fences(quality.measure(docs).select("*", *quality.measures())).collect()}
    assert limits["prose"] < limits["markup"]


def test_quantiles_of_a_blended_sketch(spark):
    """A sketch blended with its parent's gives the weighted quantile of both, within the accuracy."""
    values = spark.createDataFrame([("en", "a", 0.1 * (k + 1), 0.0, 0.0, 1.0 + k) for k in range(50)] + [("en", "b", 9.0, 0.0, 0.0, 400.0)] * 300, ["lang", "source", *quality.MEASURES])
    high = {r.source: r for r in quality.fences(values).collect()}

    def expected(own, parent, q):
        # The language is everything here, so its blend has its own shape.
        weighted = sorted([(v, 1.0) for v in own] + [(v, quality.PRIOR / len(parent)) for v in parent])
        upto = 0.0
        for v, w in weighted:
            upto += w
            if upto >= q * (len(own) + quality.PRIOR):
                return v

    a, b = [1.0 + k for k in range(50)], [400.0] * 300
    for source, own in (("a", a), ("b", b)):
        for name, q in (("low", 1 - quality.TAIL), ("middle", 0.5), ("high", quality.TAIL)):
            assert abs(high[source].chars_per_word[name] / expected(own, a + b, q) - 1) <= 2 * quality.ACCURACY


def test_budgets_fill_siblings_before_ancestors(spark):
    supply = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 100), ("a", "y", "1", 100), ("b", "x", "1", 1000)], "domain string, language string, origin string, tokens long")
    rows = mixture.budgets(supply, {}, F.lit(200.0), 1).collect()
    # Each domain gets 100, each language of a 50; the short origin's rest goes to its sibling.
    assert {(r.domain, r.language, r.origin): round(r.granted, 6) for r in rows} == {("a", "x", "1"): 10, ("a", "x", "2"): 40, ("a", "y", "1"): 50, ("b", "x", "1"): 100}


def test_mixture_takes_seeded_prefixes_within_budget(docs):
    rows = mixture.mix(docs, F.lit("all"), {"language": {"en": 2.0}}, share=0.5, max_epochs=2).collect()
    total = sum(len(tokens(t)) for _, t, *_ in documents())
    assert sum(r.tokens * r.copies for r in rows) <= total * 0.5 + 1 and all(1 <= r.copies <= 2 for r in rows)
    assert Counter(rows) == Counter(mixture.mix(docs, F.lit("all"), {"language": {"en": 2.0}}, share=0.5, max_epochs=2).collect())
    kept = mixture.mixed_rows(docs, F.lit("all"), mixture.mix(docs, F.lit("all"), {}, share=1.0, max_epochs=1))
    assert kept.count() == len(documents()) and kept.columns == docs.columns


def test_reply_trees(spark):
    rows = [
        (1, 0, None, 0.0, "system", "be <|im_end|> \\ <\\| kind"), (1, 1, 0, 1.0, "user", "hi"), (1, 2, 1, 5.0, "assistant", "best <|"), (1, 3, 1, 2.0, "assistant", "other"),
        (1, 4, 3, 9.0, "user", None), (2, 0, 7, None, None, ""), (3, 1, 2, 0.0, "user", "ring"), (3, 2, 1, 0.0, "user", "ring"), (2, 0, 7, None, None, ""),
    ]
    made = reply_trees.conversations(spark.createDataFrame(rows, "tree_id int, node_id int, parent_id int, score double, role string, text string"), per_tree=2)
    read = made.select("tree", "rank", reply_trees.turns(F.col("formatted")).alias("turns"), reply_trees.learned_text(F.col("formatted"), F.col("mask")).alias("learned")).collect()
    got = {(r.tree, r["rank"]): ([tuple(t) for t in r.turns], r.learned) for r in read}
    head = [("system", "be <|im_end|> \\ <\\| kind"), ("user", "hi")]
    assert got == {("1", 1): ([*head, ("assistant", "other"), ("user", "")], "other"), ("1", 2): ([*head, ("assistant", "best <|")], "best <|"), ("2", 1): ([("", "")], "")}


def test_line_dedup_equals_brute_force(docs):
    rows = line_runs.dedup_lines(docs).collect()
    given = documents()
    order = sorted({(i if i is not None else -1, t) for i, t, *_ in given if t is not None})
    gone = repeats([((i, t), t) for i, t in order], 50)
    want = Counter()
    for i, t, *_ in given:
        removed, out, k = gone[(i if i is not None else -1, t)] if t is not None else set(), [], 0
        for line in t.split("\n") if t is not None else []:
            spoken = bool(tokens(line))
            if not (spoken and k in removed):
                out.append(line)
            k += spoken
        want[i, "\n".join(out) if t is not None else None, len(removed)] += 1
    assert Counter((r.doc_id, r.text, r.n_removed) for r in rows) == want


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rows = packing.pack_documents(docs).collect()
    want = Counter()
    for i, t, *_ in documents():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 4096):
            part = ids[start : start + 4096]
            want[i, start // 4096, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096


def test_best_fit_plan_places_everything_once():
    rng = np.random.default_rng(5)
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, 101, 60), rng.integers(1, 60, 60), strict=True)}
    plan, opened = packing.best_fit(counts, 100)
    placed, full = Counter(), Counter()
    for length, rank, number, first, offset in plan:
        placed[length] += number
        for s in range(first, first + number):
            full[s] += length
    assert placed == Counter(counts) and max(full.values()) <= 100 and len(full) == opened
    # As many sequences as best fit decreasing opens when it takes the pieces one by one.
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = min((r for r in room if r >= length), default=None)
            if at is not None:
                room.remove(at)
            room.append((100 if at is None else at) - length)
    assert opened == len(room)


def test_language_is_told_and_rejections_are_defined(docs):
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    rows = langid.identify(docs, model).collect()
    assert len(rows) == len(documents()) and {"doc_id", "text", "source", "lang_pred", "score", "copies"} <= set(rows[0].asDict())
    told = {r.doc_id: r for r in rows}
    assert all(told[k].lang_pred == ("en" if k % 2 else "de") for k in range(24))
    assert all(told[k].lang_pred == "und" and told[k].score == 0 for k in (100, 101, 102, 107))
    assert all(0 <= r.score <= 1 for r in rows)


def test_forward_sums_all_segmentations():
    pieces = langid.pieces_of(langid.default_vocabulary())
    p = np.random.default_rng(2).random((len(pieces), 2)) / len(pieces)
    index = {t: k for k, t in enumerate(pieces.texts)}

    def total(text: str) -> np.ndarray:
        if not text:
            return np.ones(2)
        return sum((p[index[text[:n]]] * total(text[n:]) for n in range(1, min(len(text), pieces.longest) + 1) if text[:n] in index), langid.FLOOR * total(text[1:]))

    with np.errstate(over="ignore"):
        got = langid.word_scores(["therein", "ß漢字x"], pieces, p)
    assert np.allclose(got, [np.log(total(langid.MARK + w)) for w in ("therein", "ß漢字x")])


def test_long_words_are_never_cut(monkeypatch):
    """Words beyond any ring, rescaling and lookup chunk equal the plain recursion in exact
    logarithms; so do the expected pieces, whose characters add up to the word's."""
    pieces = langid.pieces_of(langid.default_vocabulary())
    index = {t: k for k, t in enumerate(pieces.texts)}
    p = np.random.default_rng(5).random((len(pieces), 2)) * 1e-3
    word = "thereinafterß漢" * 40 + "x" * 90
    text = langid.MARK + word
    mass = np.full((len(text) + 1, 2), -np.inf)
    mass[0] = 0.0
    for end in range(1, len(text) + 1):
        ways = [mass[end - 1] + np.log(langid.FLOOR)]
        ways += [mass[end - n] + np.log(p[index[text[end - n : end]]]) for n in range(1, min(end, pieces.longest) + 1) if text[end - n : end] in index]
        mass[end] = np.logaddexp.reduce(ways, axis=0)
    monkeypatch.setattr(langid, "CELLS", 64)
    with np.errstate(over="ignore"):
        assert np.allclose(langid.word_scores(["an", word], pieces, p)[1], mass[-1])
        uses = langid.expected_pieces([word], np.array([[3.0, 0.0]]), pieces, p)
    covered = (uses[:, 0] * [len(t) for t in pieces.texts]).sum()
    assert np.isfinite(uses).all() and covered <= 3 * len(text) + 1e-6 and covered > 3 * 0.9 * (len(text) - 40) and not uses[:, 1].any()


def test_fingerprints(docs):
    rows = merkle.edit_check(docs).collect()
    assert len(rows) == len(documents())
    order = sorted({(i, t or "") for i, t, *_ in documents()}, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for (i, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = next(r for r in rows if r.doc_id == i)
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.near_edited == 1.0) == (edited == text) and 0 <= row.near_next <= 1


def test_edits_are_located(spark):
    text = [f"Sentence number {k}. " for k in range(40)]
    other = list(text)
    other[20] = "Something else. "
    row = spark.createDataFrame([("".join(text), "".join(other))], "a string, b string").select(merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b"))
    out = row.select(merkle.edited_sections(F.col("a"), F.col("b")).alias("s"), merkle.edited_paragraphs(F.col("a"), F.col("b")).alias("p")).first()
    assert (out.s, out.p) == ([1], [20])


def test_revisits(spark):
    rows = [
        (1, "http://WWW.a.org:80/x/?b=2&utm_source=f&a=1#q", 10, "response", {"ETag": '"v1"', "Content-Type": "text", "Date": "old"}),
        (2, "https://a.org/x?a=1&b=2", 20, "response", {"ETag": '"v2"', "Content-Type": "html"}),
        (3, "https://a.org/x?a=1&b=2", 15, "revisit", {"etag": 'W/"v1"', "date": "new", "Content-Type": "no"}),
        (4, "https://a.org/x?a=1&b=2", 20, "revisit", {"etag": '"v2"'}), (5, "https://a.org/x?a=1&b=2", 30, "revisit", None),
        (6, "https://a.org/y", 30, "revisit", {"etag": '"v2"'}), (7, None, None, "revisit", None), (8, "https://a.org/x?a=1&b=2", 99, "other", None),
        (3, "https://a.org/x?a=1&b=2", 15, "revisit", {"etag": 'W/"v1"', "date": "new", "Content-Type": "no"}),
    ]
    out = revisits.resolve(spark.createDataFrame(rows, "record_id int, url string, time int, kind string, headers map<string,string>")).collect()
    assert Counter((r.record_id, r.status, r.response_id) for r in out) == Counter(
        {(3, "resolved", 1): 2, (4, "mismatch", 1): 1, (5, "unverified", 2): 1, (6, "no_response", None): 1, (7, "no_response", None): 1}
    )
    assert next(r.headers for r in out if r.record_id == 3) == {"etag": 'W/"v1"', "content-type": "text", "date": "new"}


def test_as_of_join_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(k, f"http://h/{min(int(u), 3)}", int(t), "revisit" if r else "response", {"etag": "x"}) for k, (u, t, r) in enumerate(zip(rng.integers(0, 9, 600), rng.integers(0, 300, 600), rng.random(600) < 0.4, strict=True))]
    out = revisits.resolve(spark.createDataFrame(rows, "record_id int, url string, time int, kind string, headers map<string,string>")).collect()
    for r in out:
        _, url, time, _, _ = rows[r.record_id]
        want = max(((t, i) for i, u, t, kind, _ in rows if kind == "response" and u == url and t < time), default=(None, None))[1]
        assert r.response_id == want


def test_empty_tables(nothing, spark):
    assert bit_mixing.score_texts(nothing, F.lit(True)).count() == 0
    assert shingle_join.similar_sets(nothing).count() == 0
    assert quality.judge(nothing).count() == 0
    assert mixture.mix(nothing, F.lit("all"), {}).count() == 0
    assert line_runs.dedup_lines(nothing).count() == 0
    assert packing.pack_documents(nothing).count() == 0
    assert langid.identify(nothing, langid.fit(nothing)).count() == 0
    assert merkle.edit_check(nothing).count() == 0
    assert reply_trees.conversations(spark.createDataFrame([], "tree_id int, node_id int, parent_id int, score double, role string, text string")).count() == 0
    assert revisits.resolve(spark.createDataFrame([], "record_id int, url string, time int, kind string, headers map<string,string>")).count() == 0


def test_clashing_and_dotted_columns_are_kept(spark):
    names = ["_doc", "_hash", "_removed", "_hit", "row", "_domain", "_language", "_origin", "a.b"]
    rows = [(k, "w " * 30 + f"\n{k}", "en", "s1", 0, *["mine"] * len(names)) for k in range(6)]
    given = spark.createDataFrame(rows, ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"`{n}` string" for n in names]]))
    clean = line_runs.dedup_lines(given, min_words=20)
    mixed = mixture.mixed_rows(given, F.lit("all"), mixture.mix(given, F.lit("all"), {}, share=1.0, max_epochs=1))
    told = langid.identify(given, langid.fit(given))
    for made in (clean, mixed, told):
        found = made.collect()
        assert len(found) == 6 and {tuple(r[n] for n in names) for r in found} == {("mine",) * len(names)}
    assert sum(r.n_removed for r in clean.collect()) == 5


def test_mixture_spends_its_budget(spark):
    docs = spark.createDataFrame([(k, "w " * (1 + k % 40), f"l{k % 3}", f"s{k % 7}") for k in range(3000)], "doc_id long, text string, lang string, source string")
    chosen = mixture.mix(docs, F.lit("all"), {"language": {"l0": 3.0}}, share=0.5, max_epochs=1)
    total = sum(1 + k % 40 for k in range(3000))
    assert abs(sum(r.tokens * r.copies for r in chosen.collect()) - total / 2) <= 40


def test_packing_works_on_little_text_at_once(spark, monkeypatch):
    """A worker's memory follows the text it works on; the pieces do not depend on it."""

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, cut, schema):
            return cut

    texts = [" ".join(f"w{(k * j) % 97}" for j in range(20_000)) for k in range(80)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(80)), "text": texts})
    seen, coded_words = [], packing.coded_words
    monkeypatch.setattr(packing, "coded_words", lambda text, lower: seen.append(sum(map(len, text.to_pylist()))) or coded_words(text, lower=lower))
    found = [row for out in packing.pieces(Docs())([batch]) for row in out.to_pylist()]
    assert sum(seen) == sum(map(len, texts)) and max(seen) <= (2 << 20) + max(map(len, texts))
    alone = [row for k in (3, 79) for out in packing.pieces(Docs())([batch.slice(k, 1)]) for row in out.to_pylist()]
    assert [row for row in found if row["doc_id"] in (3, 79)] == alone


def test_sets_are_made_of_little_text_at_once(spark, monkeypatch):
    class Docs:
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, make, schema):
            return make

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": [" ".join(f"w{(k * j) % 89}" for j in range(20_000)) for k in range(60)]})
    seen, token_sets = [], shingle_join.token_sets
    monkeypatch.setattr(shingle_join, "token_sets", lambda texts, size: seen.append(sum(map(len, texts.to_pylist()))) or token_sets(texts, size))
    monkeypatch.setattr(shingle_join, "frequent_tokens", lambda docs, size: np.zeros(0, np.uint64))
    made = [row for out in shingle_join.indexed(Docs(), 4, 85)([batch]) for row in out.to_pylist()]
    assert [row["doc_id"] for row in made] == list(range(60)) and max(seen) <= (2 << 20) + 80_000


def test_words_stay_remembered_from_block_to_block():
    """Texts bring some 27,000 new words a MB: what a worker forgets it must encode again.
    Ids are the same after words were forgotten, too."""
    ids, encoded = packing.WordIds(packing.default_tokenizer()), []
    once = ids.encoded
    ids.encoded = lambda words: (encoded.append(len(words)), once(words))[1]
    for _ in range(2):
        for k in range(0, 400_000, 50_000):
            ids.of(pa.array([f"w{i}" for i in range(k, k + 50_000)]))
    assert sum(encoded) == 400_000


def test_ids_after_words_were_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    ids = packing.WordIds(packing.default_tokenizer())
    for words in (["one", "two,", "3x", "four"], ["four", "x-y", "two,", "five"], ["five", "one", "9", "six!"], ["six!", "one"]):
        flat, first, n = ids.of(pa.array(words))
        plain = [e.ids for e in ids.tokenizer.encode_batch(words, add_special_tokens=False)]
        assert [flat[a : a + k].tolist() for a, k in zip(first, n, strict=True)] == plain


def test_languages_are_told_on_little_text_at_once(spark, monkeypatch):
    given = spark.createDataFrame([(k, prose(k, 80, ENGLISH if k % 2 else GERMAN), "en" if k % 2 else "de") for k in range(12)], "doc_id long, text string, lang string")
    caught, plain = [], type(given).mapInArrow
    model = langid.fit(given)
    monkeypatch.setattr(type(given), "mapInArrow", lambda self, tell, schema: (caught.append(tell), plain(self, tell, schema))[1])
    langid.identify(given, model, keep=["doc_id"])
    texts = [" ".join(f"the{(k * j) % 97}" for j in range(20_000)) for k in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], names=["c0", "c1"])
    seen, coded_words = [], langid.coded_words
    monkeypatch.setattr(langid, "coded_words", lambda text, lower: seen.append(sum(map(len, text.to_pylist()))) or coded_words(text, lower=lower))
    told = [row for out in caught[0](iter([batch])) for row in out.to_pylist()]
    assert [row["c0"] for row in told] == list(range(60)) and sum(seen) == sum(map(len, texts))
    assert max(seen) <= (2 << 20) + max(map(len, texts))


def test_a_worker_keeps_what_one_operator_remembers():
    """Workers outlive a stage: words remembered for packing must not stay while languages are told."""
    words = weakref.ref(packing.word_ids(packing.default_tokenizer()))
    assert words() is packing.word_ids(packing.default_tokenizer())
    langid.pieces_of(langid.default_vocabulary())
    gc.collect()
    assert words() is None


def test_nodes_alike_in_a_key_only_are_not_paired(spark):
    """A bucket of sets that share a passage and little else makes next to no pairs, and similar
    sets meet once, whichever of them is the hub."""
    rng = np.random.default_rng(5)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    passage = draw(20)
    sets = [np.union1d(passage, draw(60)) for _ in range(60)]
    sets += [np.union1d(s[:-2], draw(2)) for s in sets[:10]]
    rows = [(k, len(s), 0, False, shingle_join.short_sketch(s).tolist()) for k, s in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, n long, own long, whole_rare boolean, bits array<long>")
    pairs = nodes.crossJoin(nodes.toDF("hub", "hub_n", "hub_own", "hub_whole_rare", "hub_bits"))
    met = sorted((r["hub"], r["node"]) for r in pairs.where(shingle_join.possible(85)).select("hub", "node").collect())
    alike = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))
    true = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if alike(sets[a], sets[b])]
    assert set(true) <= set(met) and len(true) == 10 and len(met) == len(set(met)) <= 15
