"""Repeated sentence runs: a direct evaluation, planted passages and clean texts."""

import random

import numpy as np
import pytest

from helpers import WORDS, clashing, prose, sentence
from marketstream.llm import queries, spans, words


def brute(docs, least_words=spans.LEAST_WORDS, least=spans.LEAST_SENTENCES):
    """The sentences that each document loses, from its sentences as word tuples."""
    cut, keeper = {}, {}
    for key, text in docs:
        raw = (text or "").encode()
        found = words.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.ALPHANUMERIC)
        s = spans.sentences(found)
        said = [bytes(raw[a:b]).lower() for a, b in zip(found.starts, found.ends, strict=True)]
        cut[key] = [tuple(said[a:b]) for a, b in zip(s.first, s.after, strict=True)]
    runs = {}
    for key in cut:
        own, runs[key] = cut[key], []
        for i in range(len(own)):
            j = i + 1
            if len(own[i]) < spans.LONG_RUN:
                j = i + least
                while j <= len(own) and sum(map(len, own[i:j])) < least_words:
                    j += 1
            if j <= len(own):
                run = tuple(w for x in own[i:j] for w in x)
                runs[key].append((run, i, j))
                keeper[run] = min(keeper.get(run, (key, i)), (key, i))
    return {key: {k for run, i, j in found if keeper[run] != (key, i) for k in range(i, j)} for key, found in runs.items()}, cut


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, 6, 9), sentence(rng, 60), " ".join(rng.choice(WORDS) for _ in range(70)), prose(rng, 3, 20)]
    texts = []
    for i in range(50):
        own = [prose(rng, rng.randrange(1, 6)) for _ in range(3)]
        if i % 3 == 0:
            own.insert(rng.randrange(3), rng.choice(passages))
        texts.append(rng.choice(["\n", " "]).join(own))
    return [*texts, "same. " * 90, texts[3]]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make, seed):
    texts = corpus(seed)
    gone, cut = brute(list(enumerate(texts, 1)))
    for r in spans.deduplicated(make(texts)).collect():
        key = r["doc_id"]
        assert (r["n_sentences"], r["n_removed"]) == (len(cut[key]), len(gone[key]))
        assert r["n_words_removed"] == sum(len(cut[key][i]) for i in gone[key])
        left = [w for i, s in enumerate(cut[key]) if i not in gone[key] for w in s]
        raw = r["text"].encode()
        found = words.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.ALPHANUMERIC)
        assert [bytes(raw[a:b]).lower() for a, b in zip(found.starts, found.ends, strict=True)] == left


def cut_alike(text):
    raw = (text or "").encode()
    found = words.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.ALPHANUMERIC)
    s = spans.sentences(found)
    said = [bytes(raw[a:b]).lower() for a, b in zip(found.starts, found.ends, strict=True)]
    return [tuple(said[a:b]) for a, b in zip(s.first, s.after, strict=True)]


def by_all_runs(docs):
    """How many words each document loses when every run of at least two sentences and enough words counts."""
    cut, keeper, runs = {key: cut_alike(text) for key, text in docs}, {}, {}
    for key, own in cut.items():
        runs[key] = []
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                size = sum(map(len, own[i:j]))
                if size >= spans.LEAST_WORDS and (j - i >= spans.LEAST_SENTENCES or size >= spans.LONG_RUN):
                    run = tuple(w for x in own[i:j] for w in x)
                    runs[key].append((run, i, j))
                    keeper[run] = min(keeper.get(run, (key, i)), (key, i))
    gone = {key: {k for run, i, j in found if keeper[run] != (key, i) for k in range(i, j)} for key, found in runs.items()}
    return {key: sum(len(cut[key][k]) for k in found) for key, found in gone.items()}


def test_every_sentence_of_a_repeated_run_goes(spark, make, tmp_path):
    rng = random.Random(11)
    shapes = [(10, 10, 10, 3), (3, 10, 10, 10), (9, 3, 9), (2, 2, 20, 2, 2), (16, 1), (1, 1, 1, 13), (20, 5, 1, 1)]
    passages = [" ".join(sentence(rng, n) + "." for n in shape) for shape in shapes]
    texts = [*passages, *passages] + [prose(rng, 2) + "\n" + p + "\n" + prose(rng, 2) for p in passages]
    texts += [" ".join(sentence(rng, rng.randrange(1, 14)) + "." for _ in range(8)) for _ in range(6)] * 2
    make(texts).write.parquet(f"{tmp_path}/documents.parquet")
    lost = {r["doc_id"]: r["n_words_removed"] for r in queries.op7_sentence_spans(spark, str(tmp_path)).collect()}
    assert lost == by_all_runs(list(enumerate(texts, 1)))
    sizes = [sum(shape) for shape in shapes]
    assert [lost[i] for i in range(1, 22)] == [0] * 7 + sizes + sizes


def test_passages_in_unmarked_text_go_as_a_whole(spark, make, tmp_path):
    rng = random.Random(12)
    around = lambda p: f"{sentence(rng, 40)} {p} {sentence(rng, 40)}"
    passages = [sentence(rng, n) for n in (16, 17, 20, 30, 51, 60)]
    # The first sentence stands alone, then is joined to other words; the same for the last one.
    marked = [". ".join(sentence(rng, n) for n in shape) for shape in ((10, 12, 9, 11), (20, 12, 9, 18), (16, 8, 8, 16), (24, 3, 9, 24))]
    texts = [around(p) for p in passages] + [around(p) for p in passages]
    texts += [p + "." for p in marked] + [sentence(rng, 30) + " " + p + "." for p in marked] + [p + " " + sentence(rng, 30) for p in marked]
    make(texts).write.parquet(f"{tmp_path}/documents.parquet")
    lost = [r["n_words_removed"] for r in sorted(queries.op7_sentence_spans(spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])]
    sizes = [len(p.split()) for p in marked]
    assert lost == [0] * 6 + [16, 17, 20, 30, 51, 60] + [0] * 4 + sizes * 2


def test_marks_of_other_scripts(spark, make, tmp_path):
    rng = random.Random(13)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n))
    shared = [han(9) + "。" + han(12) + "！", f"{sentence(rng, 9)}؟ {sentence(rng, 9)}।"]
    texts = [a + p + b for p in shared for a, b in ((han(7) + "。", han(8) + "？"), (han(6) + "。", han(5) + "。"))]
    make(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op7_sentence_spans(spark, str(tmp_path)).collect()}
    assert [rows[i]["n_words_removed"] for i in (1, 2, 3, 4)] == [0, 21, 0, 18]
    assert rows[2]["text"] == texts[1].replace(shared[0], "") and rows[2]["n_sentences"] == 4


def test_planted_passages_go_and_clean_texts_stay(make):
    rng = random.Random(9)
    clean = [prose(rng, 12) for _ in range(40)]
    passages = [prose(rng, 7, 9), sentence(rng, 55)]
    texts = list(clean)
    for i, passage in enumerate(passages):
        for k in (3 + i, 13 + i, 23 + i):
            texts[k] = clean[k] + "\n" + passage + "\n" + clean[k + 10]
    texts = texts[:33]
    rows = {r["doc_id"] - 1: r for r in spans.deduplicated(make(texts)).collect()}
    for i, passage in enumerate(passages):
        assert passage in rows[3 + i]["text"]
        for k in (13 + i, 23 + i):
            assert len(set(passage.split()) & set(rows[k]["text"].split())) < 0.35 * len(set(passage.split()))
    for k in set(range(33)) - {3, 4, 13, 14, 23, 24}:
        assert rows[k]["text"] == texts[k]


def test_only_what_goes_is_written(make, monkeypatch):
    rng, rows = random.Random(14), {}
    keep = spans.written

    def counted(df, name):
        out = keep(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(spans, "written", counted)
    clean = [prose(rng, 12) for _ in range(30)]
    assert all(r["n_removed"] == 0 for r in spans.deduplicated(make(clean)).collect())
    assert set(rows.values()) == {0}
    # A copy that the same task reads is one range of sentences a round, not a row per run.
    rows.clear()
    got = {r["doc_id"]: r["n_removed"] for r in spans.deduplicated(make([clean[0]] * 5).coalesce(1)).collect()}
    assert got == {1: 0} | dict.fromkeys(range(2, 6), 12)
    assert rows["repeated-runs"] <= 4 * 2 * spans.ROUNDS


def test_touching_ranges_are_joined():
    text, first, after = (np.array(x) for x in ([0, 0, 0, 0, 2, 2, 3], [0, 1, 4, 9, 0, 7, 7], [3, 2, 6, 12, 7, 9, 8]))
    assert [list(x) for x in spans.joined(text, first, after)] == [[0, 0, 0, 2, 3], [0, 4, 9, 0, 7], [3, 6, 12, 9, 8]]


def test_odd_rows(odd, empty):
    rows = spans.deduplicated(clashing(odd, "doc", "first", "order", "gone")).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["text"] is None and by[5]["text"] == "" and by[6]["text"] == " \n\t " and by[12]["text"] == "né\x00ro a\x00"
    assert by[1]["n_removed"] == 0 and all(r["n_removed"] > 0 for r in rows if r["doc_id"] == 2)
    assert spans.deduplicated(empty).collect() == []
