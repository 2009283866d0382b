"""The backoff model against a direct evaluation of its definition."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import clashing
from marketstream.llm import katz

END, START = "</s>", "<s>"


def tokens(text):
    return [*(w.decode(errors="surrogateescape") for w in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())), END]


def brute(train):
    """P(b | a) as a function, and the counts."""
    words, pairs, firsts = Counter(), Counter(), Counter()
    for text in train:
        seq = tokens(text)
        words.update(seq)
        pairs.update(zip([START, *seq], seq, strict=False))
        firsts.update([START, *seq[:-1]])
    total = sum(words.values())
    fw = katz.discounts(Counter(words.values()))
    cut = lambda c, f: f[c - 1] * c if c <= len(f) else c
    off = sum(c - cut(c, fw) for c in words.values()) / total
    unknown = max(off, 0.5 / (total + 0.5 * (len(words) + 1)))
    one = {w: cut(c, fw) / total * (1 - unknown) / (1 - off) for w, c in words.items()}
    fp = katz.discounts(Counter(pairs.values()))
    seen = defaultdict(dict)
    for (a, b), c in pairs.items():
        if c >= katz.LEAST_PAIR:
            seen[a][b] = cut(c, fp) / firsts[a]
    for a, d in seen.items():
        most = firsts[a] / (firsts[a] + 0.5)
        shrink = min(1, most / sum(d.values()))
        seen[a] = {b: p * shrink for b, p in d.items()}
    alpha = {a: (1 - sum(d.values())) / (1 - sum(one[b] for b in d)) for a, d in seen.items()}
    two = lambda a, b: seen[a][b] if b in seen.get(a, ()) else alpha.get(a, 1.0) * one.get(b, unknown)
    return two, words, firsts, unknown


def corpus(seed):
    rng = random.Random(seed)
    names = [f"w{int(rng.paretovariate(0.7))}" for _ in range(150)]
    texts = [" ".join(rng.choice(names) for _ in range(rng.randrange(40))) for _ in range(150)]
    return [*texts, "", None, "W1 w1\tw1", "never seen", texts[0], texts[0]]


@pytest.mark.parametrize(("seed", "hot"), [(1, (1 << 18, 1 << 20)), (2, (4, 3)), (3, (0, 0))])
def test_equals_the_definition(make, monkeypatch, seed, hot):
    monkeypatch.setattr(katz, "HOT_WORDS", hot[0])
    monkeypatch.setattr(katz, "HOT_PAIRS", hot[1])
    texts = corpus(seed)
    docs = [(i, t, "a") for i, t in enumerate(texts)]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in docs}
    two, words, firsts, _ = brute([t for i, t, _ in docs if not held[i]])
    total, size = sum(words.values()), sum(words.values()) + 0.5 * (len(words) + 1)
    got = {r["doc_id"]: r for r in katz.report(make(docs)).collect()}
    assert len(got) == len(docs) and 10 < sum(held.values()) < 60
    for i, text, _ in docs:
        seq, r = tokens(text), got[i]
        assert (r["held_out"], r["train_tokens"], r["n_tokens"]) == (held[i], total, len(seq))
        assert r["n_known"] == sum(words[w] > 0 for w in seq)
        assert r["base_score"] == pytest.approx(sum(math.log10((words[w] + 0.5) / size) for w in seq))
        assert r["score"] == pytest.approx(sum(math.log10(two(a, b)) for a, b in zip([START, *seq], seq, strict=False)))


def test_pairs_seen_once_keep_their_discounted_share(make):
    texts = ["x y", "x y", "x z", "x v", "u z", "u y z"]
    pairs, words = Counter(), Counter()
    for text in texts:
        seq = tokens(text)
        words.update(seq)
        pairs.update(zip([START, *seq], seq, strict=False))
    model = katz.train(make(texts))
    assert model.pairs.count() == len(pairs) and min(pairs.values()) == 1
    assert {r["count"] for r in model.pairs.collect()} == set(pairs.values())
    share = lambda a, b, of: katz.discounts(Counter(pairs.values()))[pairs[a, b] - 1] * pairs[a, b] / of
    # All pairs of the text were seen, two of them once, so nothing is left to backing off.
    wanted = share(START, "x", len(texts)) * share("x", "v", words["x"]) * share("v", END, words["v"])
    # Half a count is always left to the unseen followers of a word.
    left = {a: min(1, words[a] / (words[a] + 0.5) / sum(share(a, b, words[a]) for x, b in pairs if x == a)) for a in "xv"}
    left[START] = min(1, len(texts) / (len(texts) + 0.5) / sum(share(START, b, len(texts)) for x, b in pairs if x == START))
    assert katz.score(make(["x v"]), model).first()["score"] == pytest.approx(math.log10(wanted * math.prod(left.values())))


def test_pairs_seen_once_are_stored_only_where_asked_for(make):
    docs = make(["x y", "x y", "x z", "u v", "u v w", "x z y"])
    learned = docs.doc_id < 6
    model = katz.train(docs.select("text", "doc_id"), learned)
    every = katz.train(docs.filter(learned))
    # Of (x z), (z END), (v END), (v w) and (w END), all seen once, the last text asks for the first.
    assert sorted(r["count"] for r in every.pairs.collect()) == [1] * 5 + [2, 2, 2, 2, 3]
    assert sorted(r["count"] for r in model.pairs.collect()) == [1, 2, 2, 2, 2, 3]
    assert model[2:] == pytest.approx(every[2:])
    few = {r["doc_id"]: r["score"] for r in katz.score(docs, model, learned=learned).collect()}
    assert few == pytest.approx({r["doc_id"]: r["score"] for r in katz.score(docs, every).collect()})


def test_counts_of_pairs_go_when_the_model_stands(make, monkeypatch):
    kept, names = katz.written, []
    monkeypatch.setattr(katz, "written", lambda df, name: names.append((name, out := kept(df, name))) or out)
    katz.train(make(["x y", "x z"]))
    left = {name: all(os.path.exists(f.removeprefix("file://")) for f in df.inputFiles()) for name, df in names}
    assert left == {"word-counts": False, "pair-counts": False, "contexts": False, "pairs": True, "words": True}


def test_probabilities_add_up_to_one():
    two, words, firsts, unknown = brute([t for t in corpus(4) if t])
    for a in firsts:
        assert sum(two(a, b) for b in words) + two(a, "unknown") == pytest.approx(1)


def test_hot_rows_are_found():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 1000):
        keys = np.unique(np.append(rng.integers(0, 1 << 64, n, np.uint64), np.array([katz.END, 3, 4, (1 << 64) - 1][: n], np.uint64)))
        rng.shuffle(keys)
        asked = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 500, np.uint64), np.array([0, 1], np.uint64)])
        hot = katz.hot_table(keys, [keys * np.uint64(3)])
        at, known = hot.look_up(asked)
        assert known.tolist() == np.isin(asked, keys).tolist()
        assert (hot.values[0][at[known]] == asked[known] * np.uint64(3)).all()


def test_discounts():
    usual = katz.discounts({1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 75})
    assert all(0 < d < 1 for d in usual) and usual == sorted(usual)
    # The mass taken off is that of the types seen once.
    off = sum((1 - d) * r * n for (r, n), d in zip({1: 1000, 2: 400, 3: 220, 4: 140, 5: 100}.items(), usual, strict=True))
    assert off == pytest.approx(1000)
    assert katz.discounts({}) == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]


def test_odd_rows(odd, empty):
    rows = katz.report(clashing(odd, "row", "key", "count", "score")).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5, 6)} == {1}
    assert katz.report(empty).collect() == []
    blind = katz.score(odd, katz.train(empty)).collect()
    assert len(blind) == odd.count() and not any(r["n_known"] for r in blind)
