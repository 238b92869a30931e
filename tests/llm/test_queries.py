"""The registered queries over the smallest test tables: DuckDB where SQL can say it, brute force in Python elsewhere."""

import bisect
import collections
import hashlib
import itertools
import os
import re
import zlib

import numpy as np
import pytest
import regex
import zstandard

from salestax_spark.llm import fingerprint, language
from salestax_spark.llm.queries import ORACLES, QUERIES
from testbed.parity import _normal, duck

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert _normal(df.columns, [tuple(r) for r in df.collect()]) == _normal(columns, result.fetchall())


def test_language_accuracy_on_held_out_rows(spark, con):
    known = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op1_language_id"](spark, SF_DIR).collect()
    assert len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and known[r.doc_id] is not None and r.lang_pred != "und"]
    assert sum(r.lang_pred == known[r.doc_id] for r in judged) >= 0.9 * len(judged)


def test_languages_equal_plain_compression(spark, con, texts):
    """Every whole text against zstandard used by hand: the language whose dictionary makes its blocks smallest, and by how much."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    dictionaries = language.learn_dictionaries(table.where("pmod(crc32(CAST(doc_id AS string)), 4) <> 2"))
    plain = {
        name: zstandard.ZstdCompressor(level=5, dict_data=zstandard.ZstdCompressionDict(d, dict_type=1), write_content_size=False, write_dict_id=False)
        for name, d in dictionaries.items()
    }
    for r in QUERIES["op1_language_id"](spark, SF_DIR).collect():
        raw = regex.sub(r"[^\p{L}\p{M}]+", " ", texts[r.doc_id] or "").lower().encode()
        if not regex.search(r"\p{L}", texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score, r.lang_rejected) == ("und", 0.0, True)
            continue
        sizes = sorted((sum(len(c.compress(raw[i : i + 4096])) for i in range(0, len(raw), 4096)), name) for name, c in plain.items())
        lead = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        assert (r.lang_pred, r.score) == (sizes[0][1], lead) and r.lang_rejected == (lead < 0.002)


def test_secrets(spark, texts):
    plain = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 12, 2),
        ("access", re.compile("AKIA[A-Z0-9]+"), 18, 0),
        ("hex", re.compile("[0-9a-f]+"), 16, 0),
    )
    for r in QUERIES["op2_secret_scan"](spark, SF_DIR).collect():
        found = [
            (m.start(), i, m.end()) for i, (_, p, least, g) in enumerate(plain) for m in p.finditer(texts[r.doc_id] or "") if len(m[g]) >= least
        ]
        listed = ",".join(f"{plain[i][0]}:{s}:{e}" for s, i, e in sorted(found))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(i == k for _, i, _ in found) for k in range(3)]
        assert set(listed.split(",")) <= set(r.spans.split(","))


def test_fingerprints(spark, texts):
    ids = sorted(texts)
    rows = {r.doc_id: r for r in QUERIES["op7_weighted_fingerprints"](spark, SF_DIR).collect()}
    assert sorted(rows) == ids
    errors = []
    for k, i in enumerate(ids):
        following_id = ids[(k + 1) % len(ids)]
        text, following = texts[i] or "", texts[following_id] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert rows[i].n_chars == len(text)
        one, two, ahead = ([p[k : k + 2] for k in range(0, len(p), 2)] for p in (rows[i].fingerprint, rows[i].edited_fingerprint, rows[following_id].fingerprint))
        assert len(one) == fingerprint.SAMPLES
        assert rows[i].near_edited == sum(map(str.__eq__, one, two)) / len(one) and rows[i].near_next == sum(map(str.__eq__, one, ahead)) / len(one)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, like in ((edited, rows[i].near_edited), (following, rows[i].near_next)):
            one, two = collections.Counter(words(text.lower())), collections.Counter(words(other.lower()))
            real = (one & two).total() / max(1, (one | two).total())
            errors.append(like - real if one or two else 0.0)
    by_text = collections.defaultdict(set)
    for i in ids:
        by_text[texts[i] or ""].add(rows[i].fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.055


def test_packing_has_the_least_padding(spark, texts):
    rows = QUERIES["op9_packing"](spark, SF_DIR).collect()
    lengths = sorted(len(words(t)) for t in texts.values())
    assert sorted(r.length for r in rows) == lengths
    ends = sorted({r.bucket_length for r in rows})
    assert all(r.bucket_length == ends[bisect.bisect_left(ends, r.length)] for r in rows)
    # The best cost of k buckets over the sorted lengths, the last one ending at the longest.
    distinct = sorted(set(lengths))
    upto = [bisect.bisect_right(lengths, x) for x in distinct]
    best = [upto[i] * x for i, x in enumerate(distinct)]
    for _ in range(7):
        best = [min([best[i]] + [best[j] + (upto[i] - upto[j]) * x for j in range(i)]) for i, x in enumerate(distinct)]
    padded = sum(r.bucket_length for r in rows)
    assert padded == best[-1]
    for _, batch in itertools.groupby(sorted(rows, key=lambda r: (r.bucket, r.batch, r.slot)), lambda r: (r.bucket, r.batch)):
        batch = list(batch)
        assert [r.slot for r in batch] == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * batch[0].bucket_length <= 16_384
