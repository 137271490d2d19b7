"""Whitening, web archives and collocations against brute force and round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import collocations, spectra, warc, whitening

VECTORS = "vec_id long, embedding array<float>, label int"
PAGES = "page_id long, url string, html string"
NAN, INF = float("nan"), float("inf")


# --- whitening ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("lanes", [1, 5])
@pytest.mark.parametrize("rows", [
    np.random.default_rng(1).standard_normal((200, 12)), np.floor(np.random.default_rng(2).standard_normal((40, 20)) * 4),
    np.repeat(np.floor(np.random.default_rng(3).standard_normal((3, 9)) * 8), 15, 0), np.zeros((20, 4)), np.ones((7, 1)),
    np.eye(8)[np.random.default_rng(4).integers(0, 8, 100)],
    np.random.default_rng(5).standard_normal((90, 3)) * np.array([1e7, 1.0, 1e-5])])
def test_rank_one_changes_give_the_scatter(rows, lanes):
    held = spectra.Spectra(lanes, rows.shape[1])
    for start in range(0, len(rows), lanes):
        held.add(rows[start:start + lanes])
    held = held.merged()
    scatter = (rows - rows.mean(0)).T @ (rows - rows.mean(0))
    values, vectors = held.values[0], held.vectors[0]
    assert held.n[0] == len(rows) and np.allclose(held.mean[0], rows.mean(0), atol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs((vectors * values) @ vectors.T - scatter).max() <= 1e-12 * max(1, np.abs(scatter).max())


def whitened_by_numpy(rows, components):
    x = np.floor(64 * np.array(rows, float)).astype(int) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    return centred @ basis / np.sqrt(values), values / np.trace(centred.T @ centred / n), ((n * x - sums) ** 2).sum(1)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(8)
    mix = rng.standard_normal((10, 10))
    good = [(i, (rng.standard_normal(10) @ mix).astype("f4").tolist(), 1) for i in range(300)]
    good += [(300, good[0][1], 2), (300, good[0][1], 2), (None, good[1][1], None), (301, [0.0] * 10, 1)]
    bad = [(400, None, 1), (401, [NAN] * 10, 1), (402, [INF] + [0.0] * 9, 1), (403, [None] + [0.0] * 9, 1), (404, [], 1)]
    table = spark.createDataFrame(good + bad, VECTORS).repartition(5)
    table = table.withColumns({c: F.lit(c) for c in ("n", "component", "whitened", "part", "state", "dim")})
    rows = whitening.whiten(table, components=6).collect()
    assert len(rows) == 6 * len(good)
    expected, explained, deviation = whitened_by_numpy([r[1] for r in good], 6)
    key = lambda r: (r["component"], r["vec_id"] is None, r["vec_id"] or 0)
    got = np.array([r["whitened"] for r in sorted(rows, key=key)]).reshape(6, -1).T
    order = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0))
    expected = expected[order]
    assert np.abs(got - expected * np.sign((got * expected).sum(0))).max() < 1e-9
    for r in rows:
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["n"] == len(good)
        assert r["identity_error"] < 1e-9
    assert sorted(int(r["deviation"]) for r in rows if r["component"] == 1) == sorted(deviation.tolist())


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], VECTORS)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1)], VECTORS)).collect()
    assert [(r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    # On one line: the second component has no variance. Another width is whitened by itself.
    line = [(i, [float(i), 2.0 * i], 0) for i in range(8)] + [(100 + i, [float(i % 3)], 0) for i in range(5)]
    rows = whitening.whiten(spark.createDataFrame(line, VECTORS).repartition(3)).collect()
    assert Counter((r["n"], r["component"], r["whitened"] is None) for r in rows) == {
        (8, 1, False): 8, (8, 2, True): 8, (5, 1, False): 5}
    with pytest.raises(Exception, match="too large for the grid"):
        whitening.whiten(spark.createDataFrame([(1, [1e38], 1)], VECTORS)).collect()


def test_deviations_beyond_64_bits_are_exact():
    centre = whitening.Centre(3_000_000_000, [5 * 3_000_000_000 + 7])
    assert [int(v) for v in centre.deviations(np.array([[5], [4_000_000]]))] == [49, (3_000_000_000 * (4_000_000 - 5) - 7) ** 2]


# --- web archives -------------------------------------------------------------------------------------------


def page_rows():
    rng = random.Random(3)
    long_page = "".join(rng.choice("abcdefgh <>\r\n") for _ in range(400_000))
    rows = [(i, f"http://a/{i}", f"<p>{i % 7}</p>" if i % 3 else f"<b>é{i}</b>") for i in range(10, 60)]
    return rows + [(1, None, None), (2, "http://b", ""), (3, "u\r\nWARC-Type: bad", long_page), (9, "x", long_page),
                   (None, "n", "only null id"), (None, "m", "only null id"), (4, "same", "twice"), (4, "same", "twice"),
                   (5, "WARC/1.1\r\n\r\n", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (6, "y", "<p>1</p>")]


def archived_by_hand(rows, least=0):
    groups = {}
    for i, (page, url, html) in enumerate(rows):
        data = (html or "").encode()
        key = data if len(data) >= least else i
        groups.setdefault(key, []).append((page is None, page or 0, url is None, url or "", data))
    found = []
    for members in groups.values():
        first = min(members)
        for k, (no_id, page, _, _, data) in enumerate(sorted(members)):
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            found.append((None if no_id else page, len(data), digest, "revisit" if k else "response",
                          (None if first[0] else first[1]) if k else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("least", [0, 8])
def test_archive_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(page_rows(), PAGES).repartition(4)
    pages = pages.withColumns({c: F.lit(c) for c in ("row", "same", "payload", "first", "record_type")})
    path = str(tmp_path / "w")
    warc.archive_pages(pages, path, least)
    got = [tuple(r)[:5] for r in warc.archived_pages(spark, path).collect()]
    assert sorted(got, key=repr) == archived_by_hand(page_rows(), least)
    found = warc.read_archive(spark, path)
    by_id = {r["record_id"]: r for r in found.where("record_type = 'response'").collect()}
    for r in found.where(F.col("record_type") == "revisit").collect():
        first = by_id[r["refers_to"]]
        assert r["payload"] is None and first["payload_digest"] == r["payload_digest"]
        assert first["payload_bytes"] == r["payload_bytes"] == len(first["payload"])
    assert found.count() == len(page_rows()) + found.where("record_type = 'warcinfo'").count()


def test_archive_of_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.archive_pages(spark.createDataFrame([], PAGES), path)
    assert warc.archived_pages(spark, path).collect() == []


def test_only_listed_files_are_read(spark, tmp_path):
    path = tmp_path / "w"
    warc.archive_pages(spark.createDataFrame([(1, "u", "x")], PAGES), str(path))
    (path / "part-left-by-a-lost-task.warc.gz").write_bytes(b"\x1f\x8bcut")
    assert warc.archived_pages(spark, str(path)).count() == 1


def test_conditions_and_pushed_filters(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.archive_pages(spark.createDataFrame(page_rows(), PAGES).repartition(2), path)
    everything = [r.asDict() for r in warc.read_archive(spark, path, payload=False).collect()]
    assert len(everything) > len(page_rows()) and not any(r["payload"] for r in everything)
    ids = lambda found: sorted(r["record_id"] for r in found.select("record_id").collect())
    kept = lambda test: sorted(r["record_id"] for r in everything if test(r))
    for condition, test in [
        (("record_type", "in", ["revisit", "warcinfo"]), lambda r: r["record_type"] in ("revisit", "warcinfo")),
        (("record_type", "<>", "response"), lambda r: r["record_type"] != "response"),
        (("target_uri", "starts", "http://a/1"), lambda r: (r["target_uri"] or "").startswith("http://a/1")),
        (("target_uri", "null"), lambda r: r["target_uri"] is None),
        (("content_length", ">", 95), lambda r: r["content_length"] > 95),
    ]:
        assert ids(warc.read_archive(spark, path, condition)) == kept(test), condition
    both = warc.read_archive(spark, path, ("record_type", "=", "revisit"), ("target_uri", "not null"))
    assert ids(both) == kept(lambda r: r["record_type"] == "revisit" and r["target_uri"] is not None)
    with pytest.raises(Exception, match="no column of a header"):
        warc.read_archive(spark, path, ("payload_bytes", "=", 1)).collect()
    # One loaded table may be filtered in several ways at once.
    found = warc.read_archive(spark, path)
    parts = found.where("record_type = 'revisit'").union(found.where("record_type = 'warcinfo'"))
    assert ids(parts) == kept(lambda r: r["record_type"] != "response")
    pushing = lambda: spark.read.format(warc.FORMAT).option("path", path).option("pushdown", "true").load()
    for test, keep in [
        ("record_type = 'revisit'", lambda r: r["record_type"] == "revisit"),
        ("record_type <> 'response'", lambda r: r["record_type"] != "response"),
        ("target_uri IS NOT NULL AND content_length > 95", lambda r: r["target_uri"] is not None and r["content_length"] > 95),
        ("payload_bytes > 100", lambda r: r["payload_bytes"] > 100),
        ("target_uri = 'x' OR content_length < 80", lambda r: r["target_uri"] == "x" or r["content_length"] < 80),
    ]:
        assert ids(pushing().where(test)) == kept(keep), test
    plan = pushing().where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (record_type" not in plan, plan


def record(kind, payload, uri="u"):
    return warc._framed([("WARC-Type", kind), ("WARC-Record-ID", f"<{uri}>"), ("WARC-Target-URI", uri),
                         ("Content-Type", "text/plain")], payload)


class Counting:
    """An open file that counts the bytes read."""

    def __init__(self, data):
        self.file, self.read_bytes = pa.BufferReader(data), 0

    def seek(self, at):
        self.file.seek(at)

    def read(self, size):
        data = self.file.read(size)
        self.read_bytes += len(data)
        return data


def zlib_member(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@pytest.mark.parametrize("pack", [bytes, zlib_member, warc._member])
def test_records_of_plain_and_compressed_files(pack):
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(900_000))
    data = b"".join(map(pack, [record("response", noise, "a"), record("metadata", b"", "b"), record("response", b"\r\n\r\nz", "c")]))
    read = list(warc.records(pa.BufferReader(data), len(data)))
    assert [(r["target_uri"], r["payload"]) for r in read] == [("a", noise), ("b", b""), ("c", b"\r\n\r\nz")]
    source = Counting(data)
    from pyspark.sql.datasource import EqualTo
    wanted = list(warc.records(source, len(data), [EqualTo(("record_type",), "metadata")]))
    assert [r["target_uri"] for r in wanted] == ["b"]
    # A payload that is not wanted is neither read nor inflated where its end is known.
    if pack is not zlib_member:
        assert source.read_bytes < 4 * warc.READ_BYTES
    with pytest.raises(ValueError):
        list(warc.records(pa.BufferReader(data[:500]), 500))


# --- collocations -------------------------------------------------------------------------------------------


def mined_by_hand(docs, least, top, longest=5):
    counts, totals = {}, Counter()
    ends = set(".,;:!?\n\x0b\x0c\r")
    for lang, text in docs:
        lang, text = lang if lang is not None else "und", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in "".join("\n" if c in ends else c for c in text).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        rows = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            score, k = min((1000 * a * totals[lang] // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
            inside = any(len(q) > len(phrase) and 100 * b >= 100 * a and b >= least and any(
                q[i:i + len(phrase)] == phrase for i in range(len(q))) for q, b in f.items())
            if not inside:
                rows.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def phrase_docs(seed, size=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    fixed = ["Ünïted nations of x", "x x x x x x", "alpha beta gamma delta epsilon zeta", "a\x1cb c d"]
    docs = []
    for i in range(size):
        text = " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))
        text += rng.choice([" ", ". ", "\t", "\r\n", "!"]) + rng.choice(fixed).upper() + rng.choice(["", ";", " ,  ."])
        docs.append((rng.choice(["en", "en", "fr", None, ""]), text))
    return docs + [("en", None), ("de", None), (None, ""), ("xx", " .,;\t"), ("en", "w0 " * 3000)]


@pytest.mark.parametrize("seed,least,top", [(1, 4, 1000), (2, 4, 10), (3, 8, 3), (4, 100, 5)])
def test_collocations_against_brute_force(spark, seed, least, top):
    docs = phrase_docs(seed)
    table = spark.createDataFrame([(t, lang, 1, "x") for lang, t in docs], "text string, lang string, n int, phrase string")
    got = collocations.collocations(table.repartition(3), least=least, top=top)
    assert sorted(tuple(r) for r in got.collect()) == mined_by_hand(docs, least, top)


def test_frontier_grows_until_the_ranks_are_settled(spark, monkeypatch):
    docs = phrase_docs(7)
    table = spark.createDataFrame([(t, lang) for lang, t in docs], "text string, lang string")
    frontiers = []
    counted = collocations._phrase_counts
    monkeypatch.setattr(collocations, "_phrase_counts", lambda *a: (frontiers.append(a[1]), counted(*a))[1])
    monkeypatch.setattr(collocations, "FIRST_FRONTIER", 2)
    got = collocations.collocations(table, least=3, top=6)
    assert sorted(tuple(r) for r in got.collect()) == mined_by_hand(docs, 3, 6)
    assert len(frontiers) > 4


def test_long_texts_fall_into_blocks(spark, monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice(["a", "b", "c", "d.", "e"]) for _ in range(20_000))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": pa.array([text.encode()])})
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 5_000)
    monkeypatch.setattr(collocations, "MAP_BITS", 1 << 12)
    blocks = list(collocations._blocks(iter([batch])))
    assert len(blocks) > 3
    counts = Counter()
    for b in collocations._word_counts(iter(blocks)):
        counts.update(dict(zip(b.column("phrase").to_pylist(), b.column("f").to_pylist())))
    assert counts == Counter(text.replace(".", " ").split())


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
