"""Each corpus operator on small hand-made rows: hard cases against expected or brute-force results."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestax_spark.llm import chat, fingerprint, jaccard, language, linededup, mixing, neardup, packing, secrets, warc
from salestax_spark.llm.common import Scratch
from salestax_spark.llm.components import connected_components
from salestax_spark.llm.shingles import Shingler

EN = "the cat sat on the mat and looked at the other cats in the house "
DE = "der hund lief \u00fcber die stra\u00dfe und sah einen anderen hund im garten "


def test_language(spark, docs):
    df = docs(EN * 9, DE * 9, EN.upper() * 2, None, "123 !", "").withColumn(
        "lang", F.when(F.col("doc_id") == 0, "en").when(F.col("doc_id") == 1, "de")
    )
    found = language.identify_languages(df, language.learn_dictionaries(df))
    got = {r.doc_id: (r.lang_pred, r.lang_rejected) for r in found.collect()}
    assert got == {0: ("en", False), 1: ("de", False), 2: ("en", False), 3: ("und", True), 4: ("und", True), 5: ("und", True)}
    assert language.identify_languages(df.limit(0), {}).count() == 0
    assert {r.lang_pred for r in language.identify_languages(df, {}).collect()} == {"und"}


def test_secrets_equal_plain_patterns(spark, docs):
    body = "A" * 30
    good = "ghp_" + body + secrets.base62_crc(body.encode()).decode()
    bad = "ghp_" + body + "zzzzzz"
    texts = [
        "\u00e9 PASSWORD = \"abcdef123456\" x token:short api_key=ABCDEFGHIJKLMNOP",
        "AKIA" + "Q" * 14 + " AKIAQ " + "0123456789abcdef0" + " deadbeef" * 3,
        good + " " + bad, None, "", "passwd:" + "a" * 100_000, "to\u212aen=abcdefabcdef", "secret=secret=abcdefghijkl",
    ]
    rows = {r.doc_id: r.secret_spans for r in secrets.scan_secrets(docs(*texts)).collect()}
    plain = {
        "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 12, 2),
        "access": (re.compile("AKIA[A-Z0-9]+"), 18, 0),
        "hex": (re.compile("[0-9a-f]+"), 16, 0),
    }
    for i, text in enumerate(texts):
        want = sorted(
            (m.start(), k, m.end()) for k, (p, least, g) in plain.items() for m in p.finditer(text or "") if len(m[g]) >= least
        )
        assert sorted((s.start, s.kind, s.end) for s in rows[i] if s.kind in plain) == want, text
    assert [s.kind for s in rows[2]] == ["github"]


def test_near_duplicates_of_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((5, 16))
    rows = [(i, [float(x) for x in base[i % 5] + rng.standard_normal(16) * 0.01], 1) for i in range(60)]
    rows += [(100 + i, rows[0][1], 1) for i in range(3)] + [(200, rows[0][1], 2), (201, rows[0][1], None), (202, None, 1)]
    rows += [(203, [0.0] * 16, 1), (204, [float("nan")] * 16, 1), (205, [1.0, None], 1), (206, [], 1), (None, rows[1][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in neardup.near_duplicates(df).collect()}
    for i, v, _ in rows[:63]:
        near = [j for j, w, label in rows[:63] + rows[-1:] if j != i and np.dot(v, w) >= 0.98 * np.linalg.norm(v) * np.linalg.norm(w)]
        assert got[i].n_links == len(near)
        assert got[i].component_id == min([i] + [j for j in near if j is not None])
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(200, 207))
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def _links_by_hand(vectors):
    x = np.array(vectors) / np.abs(vectors).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.98
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    for i in range(len(x)):
        if root[i] == i:
            todo = [i]
            while todo:
                new = np.flatnonzero(linked[todo.pop()] & (root > i))
                root[new] = i
                todo += new.tolist()
    return linked.sum(axis=1).tolist(), root.tolist()


@pytest.mark.parametrize("noise", [0.012, 0.0165, 0.03])
def test_a_dense_group_loses_no_link(spark, noise):
    """4,000 vectors of one label, nearly all or most of whose pairs are linked, far more than the windows hold; or 8 pairs among 8 million
    of a cosine just below the threshold, which windows of sorted signs may miss: no link too many, and most of them found."""
    rng = np.random.default_rng(0)
    centre = rng.standard_normal(64)
    vectors = centre / np.linalg.norm(centre) + rng.standard_normal((4000, 64)) * noise
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int").repartition(4)
    got = sorted(neardup.near_duplicates(df).collect())
    links, roots = _links_by_hand(vectors)
    if noise < 0.03:
        assert [r.n_links for r in got] == links and [r.component_id for r in got] == roots
    else:
        assert sum(links) == 16 and sum(r.n_links for r in got) >= 10 and all(r.n_links <= n for r, n in zip(got, links, strict=True))


def test_a_chain_of_blocks_is_counted_once(spark, monkeypatch):
    """A component that spans many blocks and angles: points on an arc, each linked to a few on either side."""
    monkeypatch.setattr(neardup, "COUNT_BLOCK", 16)
    angles = np.linspace(0, 3, 300)
    vectors = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label string")
    got = sorted(neardup.near_duplicates(df).collect())
    links, roots = _links_by_hand(vectors)
    assert [r.n_links for r in got] == links and [r.component_id for r in got] == roots == [0] * 300


def test_vectors_at_the_ends_of_the_range_of_doubles(spark):
    rows = [(0, [1e-200, 0.0], 1), (1, [0.0, 1e-200], 1), (2, [1e200, 1e200], 1), (3, [1e200, 0.0], 1), (4, [5e-324, 5e-324], 1), (5, [1.7e308, 1.7e308], 1)]
    rows += [(6, [1.0, 1.0], 2), (6, [1.0, 1.0], 2), (6, [2.0, 2.1], 2), (7, [1.0, 1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit("clash"))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == [(0, 1, 0, True), (1, 0, 1, True), (2, 2, 2, True), (3, 1, 0, False), (4, 2, 2, False), (5, 2, 2, False)] + [(6, 2, 6, True)] * 3 + [(7, 0, 7, True)]


def test_revisits(spark):
    rows = [
        (1, "http://A.example:80/x", 10, "response", '"1"', "p1", {"Server": "o", "etag": '"1"'}),
        (2, "http://a.example/x#f", 20, "revisit", 'W/"1"', None, {"Date": "d", "Server": "no"}),
        (3, "http://a.example/x", 200_000, "revisit", '"2"', None, {}),
        (4, "http://a.example/x", 5, "revisit", '"1"', None, {}),
        (5, None, 5, "revisit", '"1"', None, {}),
        (6, "http://a.example/x", 200_000, "revisit", None, None, None),
        (7, "http://a.example/x", 10, "revisit", '"1"', None, {}),
        (8, "http://a.example/x", 300_000, "revisit", None, "p1", {}),
    ]
    schema = "record_id long, url string, captured_at long, record_type string, etag string, payload_digest string, headers map<string,string>"
    df = spark.createDataFrame(rows, schema).withColumn("last_modified", F.lit(None).cast("string"))
    got = {r.record_id: r for r in warc.resolve_revisits(df).collect()}
    outcomes = {k: r.outcome for k, r in got.items()}
    assert outcomes == {
        2: "resolved", 3: "mismatch", 4: "no_response", 5: "no_response", 6: "unverified", 7: "no_response", 8: "resolved",
    }
    assert got[2].headers == {"Server": "o", "etag": '"1"', "Date": "d"} and got[2].response_id == 1
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def _sets(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def _groups(texts, k, percent):
    sets = [_sets(t, k) for t in texts]
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        same = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    return [len(s) for s in sets], root


def _edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("region", [256, 12])
def test_jaccard_join_is_exact(spark, docs, monkeypatch, region):
    monkeypatch.setattr(jaccard, "REGION", region)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    other = [f"v{rng.randrange(500)}" for _ in range(90)]
    texts = [_edited(rng, base, rng.randrange(5)) for _ in range(60)] + [_edited(rng, other, rng.randrange(9)) for _ in range(40)]
    texts += [" ".join(base).upper(), None, "", " \t", "one", "ONE", "a b", "a b c", "b a", texts[0], "x" * 3_000_000]
    sizes, roots = _groups(texts, 4, 85)
    got = {r.doc_id: r for r in jaccard.jaccard_classes(docs(*texts)).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == roots
    kept = jaccard.keep_one_of_each_group(docs(*texts), words=4, percent=85)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))


def test_jaccard_join_of_nothing(spark, docs):
    assert jaccard.jaccard_classes(docs("a").limit(0)).count() == 0


def test_shingles_cross_chunks():
    text = " ".join(f"word{i % 997}" for i in range(300_000)).encode()
    pieces = Shingler(4)
    (long,) = pieces.sets([text])
    assert len(long) == 997
    assert [len(s) for s in pieces.sets([b"", None, b"A b", b"a  B\x0b", b"a b c d e"])] == [0, 0, 1, 1, 2]


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    df = spark.createDataFrame(pairs, "x long, y long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "hi <turn x> </turn>\n<next/> \\"), (1, 1, "user", None), (1, 2, "assistant", "\\</turn>"),
        (1, 3, "assistant", "\u00e4\U0001f600"), (2, None, None, ""), (3, 1, "a>b\\", "\n"), (3, 0, "assistant", "x"), (None, 0, "user", "n"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df).withColumn("read", chat.read_turns(F.col("formatted")))
    out = out.withColumn("loss", chat.read_loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: ([tuple(t) for t in r.read], r.loss) for r in out.collect()}
    assert got[1] == ([("user", rows[0][3]), ("user", ""), ("assistant", rows[2][3]), ("assistant", rows[3][3])], rows[2][3] + rows[3][3])
    assert got[2] == ([("", "")], "") and got[None] == ([("user", "n")], "")
    assert got[3] == ([("assistant", "x"), ("a>b\\", "\n")], "x")
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_fingerprint_rate_is_the_weighted_jaccard_similarity(spark, docs):
    one, two = "a a a b b c d e f g", "a b b b c c x y z g"
    df = docs(one, two, None, "", one).select("doc_id", "text", F.lit(two).alias("fixed"))
    rows = {r.doc_id: r for r in fingerprint.fingerprints(df, ["doc_id"], ["text", "fixed"], samples=2048).collect()}
    pair = spark.createDataFrame([(rows[0].text_fingerprint, rows[0].fixed_fingerprint)], "a string, b string")
    like = pair.select(fingerprint.likeness(F.col("a"), F.col("b")).alias("l")).first().l
    assert abs(like - 5 / 15) < 0.05
    assert rows[0].text_fingerprint == rows[4].text_fingerprint and rows[2].text_fingerprint is None
    edited = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs(one, two, None, one)).collect()}
    assert edited[2].n_chars == 0 and set(edited[2].fingerprint) == {"0"}
    assert edited[0].fingerprint == edited[3].fingerprint and edited[3].near_next == 1.0
    assert fingerprint.edited_fingerprints(docs(one).limit(0)).count() == 0


def test_sampling_tables_follow_the_gamma_distribution():
    """Middles of equal shares: their mean is 2, and every value lies at its share of 1 - (1 + x) exp(-x)."""
    cells = fingerprint.CELLS
    r = np.array([float(v) for v in fingerprint._table(True).split()]) / fingerprint.SCALE
    c = np.exp(np.array([float(v) for v in fingerprint._table(False).split()]) / fingerprint.SCALE - fingerprint.SHIFT)
    middles = (np.arange(cells) + 0.5) / cells
    for whole in (r[:cells], c[:cells]):
        assert abs(whole.mean() - 2) < 1e-3 and np.allclose(1 - (1 + whole) * np.exp(-whole), middles, atol=1e-9)
    assert np.allclose((1 + r[cells:]) * np.exp(-r[cells:]), middles / cells, rtol=1e-6)  # large r
    assert np.allclose(c[cells:] ** 2 / 2 - c[cells:] ** 3 / 3, middles / cells, rtol=1e-2)  # small c


@pytest.mark.parametrize("scale", [1, 40])
def test_fingerprint_rate_with_many_terms_and_large_weights(spark, scale):
    """Terms of weights up to 200 in two documents; 6,000 samples in three seeds against the generalised Jaccard similarity."""
    rng = np.random.default_rng(5)
    one, two = rng.integers(0, 6, 300) * scale, rng.integers(0, 6, 300) * scale
    rows = [(0, int(t), int(a), int(b)) for t, a, b in zip(rng.integers(-(1 << 62), 1 << 62, 300), one, two, strict=True)]
    counts = spark.createDataFrame(rows, "k int, term long, a long, b long")
    got = []
    for seed in (1, 2, 3):
        prints = fingerprint.weighted_samples(counts, ["k"], ["a", "b"], samples=2001, seed=seed)
        got.append(prints.select(fingerprint.likeness(F.col("a_fingerprint"), F.col("b_fingerprint")).alias("l")).first().l)
    assert abs(np.mean(got) - np.minimum(one, two).sum() / np.maximum(one, two).sum()) < 0.02


def test_fingerprint_of_a_column_does_not_depend_on_the_others(spark):
    rows = [(k, t, *w) for k in range(3) for t, w in enumerate([(1, 1, 1), (2, 2, 1), (3, 1, 3), (0, 4, 4), (None, None, 2), (5, 0, None), (0, 0, 0)][: 7 - k])]
    counts = spark.createDataFrame(rows, "k int, term long, a long, b long, c long")
    whole = {r.k: r for r in fingerprint.weighted_samples(counts, ["k"], ["a", "b", "c"]).collect()}
    for w in "abc":
        alone = {r.k: r[1] for r in fingerprint.weighted_samples(counts, ["k"], [w]).collect()}
        assert {k: r[f"{w}_fingerprint"] for k, r in whole.items()} == alone and len(alone) == 3
    absent = spark.createDataFrame([(0, 1, 2, 0), (1, 1, 0, None), (1, 2, None, 0)], "k int, term long, a long, b long")
    got = {r.k: r for r in fingerprint.weighted_samples(absent, ["k"], ["a", "b"]).collect()}
    assert got[0].b_fingerprint is None and len(got[0].a_fingerprint) == fingerprint.SAMPLES * fingerprint.DIGITS
    assert got[1].a_fingerprint is None and got[1].b_fingerprint is None


def test_logarithms_are_taken_before_terms_are_repeated_for_their_samples(spark):
    counts = spark.createDataFrame([(0, 1, 2, 2)], "k int, term long, a long, b long")
    plan = fingerprint.weighted_samples(counts, ["k"], ["a", "b"])._jdf.queryExecution().optimizedPlan().toString().split("\n")
    repeated = next(i for i, line in enumerate(plan) if "Generate explode([0,1,2,3" in line)
    logs = [i for i, line in enumerate(plan) if "LOG(" in line.upper() or "LN(" in line.upper()]
    assert logs and min(logs) > repeated  # a plan's first line is its last step


def test_every_row_has_its_fingerprint(spark):
    """Repeated ids, equal rows, a NULL id, ids that are words, a very long text: one result per row, next to the row that follows by id."""
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [("b", "one two three four"), ("b", "five six"), ("b", "one two three four"), (None, "x y z w"), ("a", long), ("c", None), ("c", "tail end")]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("n_chars", F.lit("clash")).repartition(3)
    got = fingerprint.edited_fingerprints(df).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t or "")) for i, t in rows)
    same = [r.fingerprint for r in got if (r.doc_id, r.n_chars) == ("b", 18)]
    assert len(same) == 2 and len(set(same)) == 1
    (first,) = [r for r in got if r.doc_id is None]
    assert first.edited_sha256 == hashlib.sha256(("x y z " + long[:1]).encode()).hexdigest()
    (a,) = [r for r in got if r.doc_id == "a"]
    cut = len(long) // 4
    openings = {hashlib.sha256((long[: len(long) - cut] + (t or "")[:cut]).encode()).hexdigest() for i, t in rows if i == "b"}
    assert a.edited_sha256 in openings and a.near_edited > 0.4
    # Each row follows exactly one other: the edits of the two equal rows differ where their followers do.
    again = fingerprint.edited_fingerprints(df.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def _deleted(texts, least):
    """Brute force: lines of any run of ``least`` words or more that occurs earlier."""
    lines = [[(p, w) for p, w in enumerate((t or "").split("\n")) if w.split()] for t in texts]
    seen, gone = {}, set()
    for d, doc in enumerate(lines):
        for s in range(len(doc)):
            for e in range(s + 1, len(doc) + 1):
                run = tuple(w for _, w in doc[s:e])
                if sum(len(w.split()) for w in run) >= least and seen.setdefault(run, (d, s)) < (d, s):
                    gone |= {(d, i) for i in range(s, e)}
    # Blank lines between two deleted lines go as well.
    gone = {(d, p) for d, i in gone for p in range(lines[d][i][0], lines[d][i + 1][0] if (d, i + 1) in gone else lines[d][i][0] + 1)}
    return ["\n".join(w for p, w in enumerate(t.split("\n")) if (d, p) not in gone) if t is not None else None for d, t in enumerate(texts)]


def test_line_runs_equal_brute_force(spark, docs):
    rng = random.Random(5)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 2, 5, 9]))) for _ in range(12)] + ["", "  "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(40)] + [None, "", "\n\n"]
    got = {r.doc_id: r.text for r in linededup.delete_repeated_runs(docs(*texts), min_words=10).collect()}
    assert [got[i] for i in range(len(texts))] == _deleted(texts, 10)
    assert linededup.delete_repeated_runs(docs("a").limit(0)).count() == 0


def test_ranks_are_those_of_a_sorted_suffix_array(spark, docs):
    rng = random.Random(8)
    pool = [f"line number {i}" for i in range(4)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 30))) for _ in range(25)]
    scratch = Scratch(spark, "suffixes")
    lines = scratch.write("lines", linededup._lines(docs(*texts), "doc_id", "text"))
    ids = {}
    for r in lines.collect():
        ids.setdefault(bytes(r._doc), {})[r._i] = (r._line, r._line2)
    for k, level in enumerate(linededup.doubled_ranks(lines, 16, scratch)):
        prefixes = {(d, i): tuple(own[j] for j in range(i, i + 2**k)) for d, own in ids.items() for i in own if i + 2**k <= len(own)}
        often = {p for p, n in collections.Counter(prefixes.values()).items() if n > 1}
        place = {p: n for n, p in enumerate(sorted(often))}
        assert {(bytes(r._doc), r._i): r._rank for r in level.collect()} == {at: place[p] for at, p in prefixes.items() if p in often}


def test_line_runs_at_their_limits(spark, docs):
    """A text of one very long line, of very many lines, a hot line, and equal rows with equal and with no ids."""
    hot = "this very line is held by every third document of the table and has well over twenty words so that it is a run of its own"
    many = "\n".join(f"{i} a" for i in range(20_000))
    texts = [many, "w " * 200_000, many, *[hot if i % 3 == 0 else f"only here {i}" for i in range(90)]]
    df = docs(*texts).withColumn("doc_id", F.when(F.col("doc_id") < 90, F.col("doc_id"))).union(docs(many).select("*"))
    got = [(r.doc_id, r.n_lines, len(r.removed_runs), r.text) for r in linededup.delete_repeated_runs(df).collect()]
    assert len(got) == len(texts) + 1
    # Equal id and text are one document; of the others all but the first go.
    assert sorted(n for i, n, runs, t in got if t == many) == [20_000] * 2 and [t for i, n, runs, t in got if i == 2] == [""]
    assert sum(t == hot for *_, t in got) in (1, 2) and sum(runs for _, _, runs, _ in got) >= 29


def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 9)))
        rows = [rng.choice([1, 2, 9, 10**12]) for _ in lengths]
        ends = packing.best_boundaries(lengths, rows, 3)

        def cost(ends):
            return sum(n * min(e for e in ends if e >= length) for n, length in zip(rows, lengths, strict=True))

        assert len(ends) <= 3
        assert cost(ends) == min(cost([*c, lengths[-1]]) for k in range(3) for c in itertools.combinations(lengths[:-1], k))


def test_packing_batches(spark, docs):
    df = docs(*["w " * n for n in (1, 2, 3, 40, 41, 900)], None, "", "w " * 3)
    rows = packing.pack_documents(df, n_buckets=3, token_budget=100).collect()
    assert len(rows) == 9
    for _, batch in itertools.groupby(sorted(rows, key=lambda r: (r.bucket, r.batch)), lambda r: (r.bucket, r.batch)):
        batch = list(batch)
        assert all(r.length <= r.bucket_length for r in batch)
        assert len(batch) == 1 or len(batch) * batch[0].bucket_length <= 100
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "c", None]), "w " * rng.randrange(0, 30)) for i in range(400)]
    rows += [(1000, "a", None), (1001, "z", ""), (None, "b", "w w"), (2000, "a", "w w w"), (2000, "a", "w w w")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_report(df).collect()
    assert len(got) == len(rows)
    sizes, taken, targets = {}, {}, {}
    for r, source in [(r, {i: s for i, s, _ in rows}[r.doc_id]) for r in got]:
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        targets[source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    total = sum(sizes.values())
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    assert all(abs(taken[s] - targets[s]) <= 30 and targets[s] <= 2 * sizes[s] for s in sizes)
    mix = mixing.mix_sources(df, shards=4, blocks_per_shard=8)
    again = mixing.mix_sources(df, shards=4, blocks_per_shard=8)
    assert sorted(map(str, mix.drop("position").collect())) == sorted(map(str, again.drop("position").collect()))
    assert mixing.mix_report(df.limit(0)).count() == 0


def test_tree_keeps_every_quota(spark):
    quotas = spark.createDataFrame([(1, 37), (2, 0), (3, 100)], "_rank long, _quota long")
    rows = mixing.shard_blocks(mixing.shard_quotas(quotas, 8, 1, Scratch(spark, "tree"))).collect()
    assert sorted((r._rank, r._block) for r in rows) == [(1, b) for b in range(37)] + [(3, b) for b in range(100)]
    per_shard = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(per_shard) - min(per_shard) <= 2
    # A shard's blocks of a source are next to each other: its quota, drawn from where the shard before it ended.
    for rank in (1, 3):
        assert [r.shard for r in sorted(rows, key=lambda r: r._block) if r._rank == rank] == sorted(r.shard for r in rows if r._rank == rank)


def test_quotas_are_hypergeometric(spark):
    """Many seeds: mean and variance of a shard's blocks of a source are those of draws without replacement."""
    quotas = {1: 40, 2: 16, 3: 8}
    df = spark.createDataFrame(list(quotas.items()), "_rank long, _quota long")
    drawn = {rank: [] for rank in quotas}
    for seed in range(25):
        urns = mixing._urns(seed)
        root = df.select(F.lit(0).cast("long").alias("shard"), (F.col("_rank") % 2).alias("_group"), "_rank", "_quota")
        rows = mixing._split(mixing._split(root, 0, seed, urns), 1, seed, urns)
        found = {(r.shard, r._rank): r._quota for r in rows.collect()}
        for rank, quota in quotas.items():
            per_shard = [found.get((shard, rank), 0) for shard in range(4)]
            assert sum(per_shard) == quota
            drawn[rank] += per_shard
        assert [sum(found.get((shard, rank), 0) for rank in quotas) for shard in range(4)] == [16] * 4
    total, size = 64, 16
    for rank, quota in quotas.items():
        share = quota / total
        assert abs(np.mean(drawn[rank]) - size * share) < 1e-9
        variance = size * share * (1 - share) * (total - size) / (total - 1)
        assert 0.6 * variance < np.var(drawn[rank]) < 1.5 * variance


def test_many_sources(spark):
    """Five thousand sources of one to three documents, one of them with a third of all words."""
    docs = spark.range(15_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string"))).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"),
    )
    rows = mixing.shard_report(docs, shards=8, blocks_per_shard=1024).collect()
    sources = mixing.mix_report(docs)
    words = sources.agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).first()
    assert sum(r.words for r in rows) == words.taken and abs(words.taken / words.size - 1.5) < 0.05
    blocks = [sum(r.blocks for r in rows if r.shard == shard) for shard in range(8)]
    assert max(blocks) - min(blocks) <= 3


def test_targets_stop_at_their_cap(spark):
    """Sizes that make source after source full, against the definition: share, cut, share the excess again."""
    sizes = [1, 2, 4, 8, 16, 32, 5000, 9000, 0]
    df = spark.createDataFrame([(f"s{i}", f"{i}", n) for i, n in enumerate(sizes)], "_key string, source string, _size long")
    table, words = mixing.source_targets(df, Scratch(spark, "targets"))
    got = [r.target for r in table.orderBy("_rank").collect()]
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    left, open_, want = 1.5 * sum(sizes), set(range(len(sizes))), {}
    while open_:
        unit = left / sum(weight[i] for i in open_)
        full = {i for i in open_ if unit * weight[i] > 2 * sizes[i]}
        want |= {i: 2 * sizes[i] if i in full else unit * weight[i] for i in (full or open_)}
        left -= sum(2 * sizes[i] for i in full)
        open_ = open_ - full if full else set()
    assert np.allclose(got, [want[i] for i in range(len(sizes))], rtol=1e-12) and abs(sum(got) - words) < 1e-6


def test_held_out_is_the_checksum(spark):
    got = {r.id: r.h for r in spark.range(50).select("id", language.held_out("id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}


def test_sets_that_share_a_name_are_named_anew(spark, docs, monkeypatch):
    """A hash that gives every set one name at the first seed: the second one is used, and the groups are as before."""
    plain = jaccard._class
    monkeypatch.setattr(jaccard, "_class", lambda shingles, seed: 7 if seed == 0 else plain(shingles, seed))
    texts = ["a b c d e f", "g h i j k l", "a b c d e f", "g h i j k l m"]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_classes(docs(*texts)).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 3}


def test_long_texts_make_a_region_larger(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "POINT_BYTES", 64)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 1024)
    monkeypatch.setattr(jaccard, "REGION", 12)
    rng = random.Random(6)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [_edited(rng, base, rng.randrange(6)) for _ in range(25)] + ["v " + " ".join(f"v{i}" for i in range(40)), "one two", None]
    sizes, roots = _groups(texts, 4, 85)
    got = {r.doc_id: r for r in jaccard.jaccard_classes(docs(*texts)).collect()}
    assert [got[i].component_id for i in range(len(texts))] == roots and [got[i].n_shingles for i in range(len(texts))] == sizes
