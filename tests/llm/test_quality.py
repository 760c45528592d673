import random
import re
from collections import Counter

import numpy as np

from fairway.llm import quality


def brute(text):
    text = text or ""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    w = word.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if word.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def texts():
    rng = random.Random(5)
    parts = ["the cat sat", "on a mat.", "\n", "\n\n", "|", "#", "é漢", "\t", " ", "x", "a a a", "the cat sat", "$%"]
    out = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return [None, "", " ", "\n", "a\na\na", "a\n\na\n", " ".join("word" for _ in range(40_000))] + out


def test_statistics_and_base_rule(spark, make_docs):
    rows = list(enumerate(texts()))
    for r in quality.judge(make_docs(rows)).collect():
        n, chars, symbols, dup, rep = expected = brute(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, rows[r.doc_id]
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.base_failed and r.kept)


def test_posterior_finds_planted_junk(spark, make_docs):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "eri", "olut", "ing")]

    def prose(n):
        return " ".join(rng.choice(words) + ("." if i % 9 == 8 else "") for i in range(n))

    good = [prose(rng.randint(60, 300)) for _ in range(150)]
    junk = [" ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(120).split()) for _ in range(15)]
    shout = [" ".join(w.upper() + "!!" for w in prose(120).split()) for _ in range(15)]
    kept = {r.doc_id: r.kept for r in quality.judge(make_docs(list(enumerate(good + junk + shout)))).collect()}
    assert all(kept[i] for i in range(150)) and not any(kept[i] for i in range(150, 180))


def test_good_votes_never_count_against():
    codes = np.arange(3 ** len(quality.RULES))[::37]
    share, a1, a0 = quality.fit(codes, np.ones(len(codes)))
    assert (a1 >= 1 - a0).all()
    all_good = np.array([sum(3 ** i for i in range(len(quality.RULES)))])
    assert quality.posterior(all_good, share, a1, a0)[0] >= share


def test_empty_and_filter_keeps_columns(spark, make_docs):
    assert quality.judge(make_docs([])).count() == 0
    docs = make_docs([(1, "too short"), (2, None), (2, "x " * 10)])
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs).count() == 0


def test_fit_recovers_known_accuracies_and_a_plain_posterior():
    """Votes drawn from known accuracies: the fit on counted patterns finds them,
    and the posterior is Bayes' rule written out vote by vote."""
    rng = np.random.default_rng(11)
    m, n = len(quality.RULES), 40_000
    share, right1, right0 = 0.75, rng.uniform(0.91, 0.99, m), rng.uniform(0.3, 0.8, m)
    y = rng.random(n) < share
    right = rng.random((n, m)) < np.where(y[:, None], right1, right0)
    votes = np.where(right == y[:, None], 1, 2)          # right about good, or wrong about bad: a good vote
    votes[rng.random((n, m)) < 0.2] = 0                  # abstentions say nothing
    codes, counts = np.unique(votes @ 3 ** np.arange(m - 1, -1, -1), return_counts=True)
    got_share, a1, a0 = quality.fit(codes, counts.astype(float))
    assert abs(got_share - share) < 0.03 and np.abs(a1 - right1).max() < 0.03 and np.abs(a0 - right0).max() < 0.08
    for code, p in list(zip(codes, quality.posterior(codes, got_share, a1, a0)))[::400]:
        good, bad = got_share, 1 - got_share
        for j in range(m):
            vote = int(code) // 3 ** (m - 1 - j) % 3
            if vote:
                good *= a1[j] if vote == 1 else 1 - a1[j]
                bad *= 1 - a0[j] if vote == 1 else a0[j]
        assert np.isclose(p, good / (good + bad))
