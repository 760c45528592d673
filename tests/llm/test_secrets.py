import hashlib
import random
import re
import string

from fairway.llm import secrets

A = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in A.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(spans)


def digest(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def samples():
    rng = random.Random(11)
    bits = ["token", "Token", "API_KEY", "apikey", "=", ": ", "\"", "'", " ", "abc", "abcdef12", "AKIA" + "Q7" * 8,
            "AKIA", "0123456789abcdef" * 2, "é漢👍", "\n", "secret=token:\"abcdefgh\"", "password==", ".", "deadbeef"]
    return [None, "", "=", "token=token=abcdef123", "secret: short", "secret=token:'abcdefgh' x",
            *["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(300)],
            "token=abcdef " * 1500]


def test_base_spans_match_plain_regular_expressions(spark, make_docs):
    rows = list(enumerate(samples()))
    for r in secrets.secret_digest(make_docs(rows)).collect():
        spans = base(rows[r.doc_id][1])
        assert r.base_sha256 == hashlib.sha256(digest(spans).encode()).hexdigest(), rows[r.doc_id][1][:200]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == \
            [s for s in digest(spans).split(",") if s]


def test_models_find_random_strings_and_leave_words(spark, make_docs):
    rng = random.Random(3)
    syllables = ["tion", "ing", "ver", "con", "ment", "the", "re", "al", "ous", "in", "er", "ab"]
    prose = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 9))) for _ in range(120))
             for _ in range(30)]
    hidden = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(20)]
    rows = list(enumerate(prose)) + [(100 + i, prose[i] + " " + h + " end") for i, h in enumerate(hidden)]
    got = {r.doc_id: r.spans for r in secrets.secret_digest(make_docs(rows)).collect()}
    assert not any(got[i] for i in range(30))
    for i, h in enumerate(hidden):
        at = len(prose[i]) + 1
        assert got[100 + i] == f"markov:{at}:{at + len(h)}"


def test_no_python_in_plan(spark, make_docs):
    plan = secrets.secret_digest(make_docs([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_masking(spark, make_docs):
    docs = make_docs([(1, "a token=\"abcdef0123456789abcdef01\" é b"), (2, None), (3, "plain"), (3, "plain")])
    out = secrets.masked(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.text) == [
        (1, "a <secret>\" é b"), (3, "plain"), (3, "plain")]
    assert out.where("text is null").count() == 1


def test_empty(spark, make_docs):
    assert secrets.secret_digest(make_docs([])).count() == 0
