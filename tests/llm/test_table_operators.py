"""Mixing, sharding, archives, vectors and the pipeline: small cases, ties, nulls, empty tables, hot groups."""

import bisect
import gzip
import io
import json
import struct
import zipfile
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from comarca.llm import entries, mixing, simhash_trie, splitters, vector_graph, warc_zip

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, kept string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 1, "a", "b") for i, t, s in rows], SCHEMA)


def test_mix_meets_targets_and_ceilings(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "big" if i % 3 else ["a", "b", None][i // 3 % 3]) for i in range(3000)]
    rows += [(5000 + i, "tiny text", "small") for i in range(3)] + [(None, "no id here", "a"), (7, None, "b"), (8, "", "b")] + rows[:5]
    got = mixing.mix(docs_of(spark, rows), blocks_per_source=100).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all() and (got["taken"] >= 0).all()
    total = got["size"].sum()
    by = got.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert by["target"].sum() == pytest.approx(total) and (by["target"] <= 3 * by["size"] + 1e-9).all()
    assert ((by["taken"] - by["target"]).abs() <= total / 500 + 0.02 * by["target"]).all()
    again = mixing.mix(docs_of(spark, rows).repartition(7), blocks_per_source=100).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))


def test_small_sources_beside_a_hot_one_meet_their_targets(spark):
    rows = [(i, "w " * 100, "hot") for i in range(3000)]
    rows += [(10_000 + 100 * k + i, "w " * (1 + i), f"s{k:02}") for k in range(30) for i in range(k % 7 + 1)]
    rows += [(20_000 + i, "w " * 60, "t") for i in range(14)]
    got = mixing.mix(docs_of(spark, rows)).toPandas()
    by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["target"].drop("hot") == 3 * by["size"].drop("hot")).all() and (by["taken"] > 0).all()
    assert ((by["taken"] - by["target"]).abs() <= 0.02 * by["target"]).all()
    # A remainder that is no whole round, and one source alone.
    some = mixing.mix(docs_of(spark, [(i, "w " * 7, "ab"[i % 2]) for i in range(9)]), blocks_per_source=1).toPandas()
    by = some.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by["taken"] - by["target"]).abs() <= 0.5).all()
    assert mixing.mix(docs_of(spark, [(1, "one two three", "a")])).first()["taken"] == 3


@pytest.mark.parametrize("small", [0, 1, 40])
def test_mix_equals_its_sql_with_small_sources(spark, tmp_path, small):
    """Sources of few blocks beside a hot one, rows without an id, equal ids and equal rows."""
    rng = np.random.default_rng(5)
    rows = [(i if i % 50 else None, "w " * int(rng.integers(0, 120)), "hot") for i in range(2000)]
    rows += [(5000 + i, "v " * int(rng.integers(0, 90)), "b") for i in range(900)]
    rows += [(7 if i % 2 else 10_000 + i, f"{i} " * (1 + i % 9), f"s{k:02}") for k in range(small) for i in range(k % 7 + 1)]
    rows += [(1, "same row", "hot")] * 30 + [(2, None, None), (3, "", None)]
    docs_of(spark, rows).select("doc_id", "text", "source").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in entries.QUERIES["op6_mixing"](spark, str(tmp_path)).collect()]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = duck.execute(entries.ORACLES["op6_mixing"]).fetchall()

    def key(r):
        return tuple((x is None, x or 0) for x in r)

    assert sorted(got, key=key) == sorted(want, key=key) and len(got) == len(rows)


def test_long_documents_of_a_thinned_source_keep_their_share(spark):
    rows = [(i, "l " * 800, "a") for i in range(45)] + [(100 + i, "s " * 40, "a") for i in range(300)]
    rows += [(1000 + i, "w " * 40, "bc"[i % 2]) for i in range(800)]
    docs = docs_of(spark, rows)
    mixed = corpus_pipeline.mixed(spark, docs, SF).where("source = 'a'").toPandas()
    found = mixing.mix(docs).where("source = 'a' AND size = 800").toPandas()
    got = (mixed["text"].str.len() == 1600).sum() * 800
    assert 0.7 * found["taken"].sum() <= got <= 1.3 * found["taken"].sum()
    # Equal rows share a draw, not their fate.
    same = docs_of(spark, [(None, "l " * 800, "a")] * 45 + rows[45:])
    copies = mixing.mix(same).where("doc_id IS NULL").agg(F.sum("copies") * 800 - F.sum("taken")).first()[0]
    assert abs(copies) <= 800


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    got = mixing.mix(docs_of(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert sorted((r.doc_id, r.size, r.taken, r.target) for r in got) == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]


def test_quotas_add_up_in_every_shard(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 10), (None, 500)], "source string, source_size long")
    targets = mixing.with_block_size(mixing.source_targets(sizes), 50)
    got = mixing.block_quotas(targets, shards=4).toPandas()
    by = got.groupby("shard")["quota"].sum()
    assert by.max() - by.min() <= 1 and got["quota"].sum() == targets.first()["seats"]


def test_shards_are_even_and_copies_stay_together(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "t" * int(rng.integers(0, 400)) + f" {i // 2}", None) for i in range(4000)]
    rows += [(9000 + i, "copy " * 30, None) for i in range(1500)] + [(None, None, None), (1, "", None), (1, "", None), (2, "x" * 20_000, None)]
    got = splitters.shard(docs_of(spark, rows), shards=8, ranges_per_shard=32).toPandas()
    assert len(got) == len(rows)
    size = got.groupby("shard")["size"].sum()
    assert set(size.index) == set(range(8)) and size.max() <= 1.15 * size.mean() and size.min() >= 0.85 * size.mean()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    # Only the large group of copies may lie in several shards.
    assert (got.groupby("text_crc32")["shard"].nunique() > 1).sum() <= 1
    assert splitters.shard(docs_of(spark, [])).count() == 0
    assert splitters.shard(docs_of(spark, [(1, "a", None)])).first()["slot"] == 0


def test_group_starts_and_quantiles():
    low = splitters.LOWEST
    keys = [(i, 0, 0, 1.0) for i in range(100)]
    assert splitters.quantile_boundaries(keys, 4) == [(24, 0, 0), (49, 0, 0), (74, 0, 0)]
    assert splitters.quantile_boundaries([], 4) == []
    got = splitters.at_group_starts([(5, 1, 0), (5, 2, 0), (7, 9, 0)], 16)
    assert got == [(5, low, low), (5, 1, 0), (5, 2, 0), (7, low, low)]
    assert splitters.at_group_starts([(5, 1, 0), (7, 9, 0)], 16) == [(5, low, low), (7, low, low)]


def test_range_numbers_are_those_of_a_sorted_list(spark):
    rng = np.random.default_rng(3)
    boundaries = sorted({tuple(int(v) for v in rng.integers(-3, 4, 3)) for _ in range(60)})
    keys = [tuple(int(v) for v in rng.integers(-4, 5, 3)) for _ in range(500)] + boundaries
    rows = spark.createDataFrame(keys, "a long, b long, c long")
    got = rows.withColumn("found", splitters.range_number(boundaries, F.col("a"), F.col("b"), F.col("c"))).collect()
    assert len(got) == len(keys) and all(r.found == bisect.bisect_right(boundaries, tuple(r)[:3]) for r in got)


def check_law(got, shards, copies_cut):
    """What the law says, of every row: sizes near equal, slots without gaps, copies together."""
    sizes = got.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert sizes.max() <= 1.1 * sizes.mean() and sizes.min() >= 0.9 * sizes.mean()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert (got.groupby("text_crc32")["shard"].nunique() > 1).sum() <= copies_cut


@pytest.mark.parametrize("same", ["no id", "one id", "ids"])
def test_rows_that_repeat_are_cut_like_any_others(spark, same):
    rng = np.random.default_rng(1)
    rows = [(i, f"{i} " + "t" * int(rng.integers(0, 900)), None) for i in range(4000)]
    rows += [({"no id": None, "one id": 7, "ids": 9000 + i}[same], "the same text " * 40, None) for i in range(2000)]
    docs = docs_of(spark, rows).repartition(5)
    got = splitters.shard(docs).toPandas()
    assert len(got) == len(rows)
    check_law(got, 24, 1)
    sizes = {}
    for i, text, _ in rows:
        sizes.setdefault((i, zlib.crc32(text.encode())), []).append(len(text) + 8)
    for key, part in got.astype({"doc_id": "object"}).groupby(["doc_id", "text_crc32"], dropna=False):
        assert sorted(part["size"]) == sizes[None if key[0] != key[0] else int(key[0]), key[1]]


def test_few_long_copies_are_cut_too(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"{i} " + "t" * int(rng.integers(0, 900)), None) for i in range(1000)]
    rows += [(5000 + i, f"{i % 2} " + "long" * 5000, None) for i in range(6)] + [(6000, "one long" * 2000, None), (6001, "x" * 16_000, None)]
    got = splitters.shard(docs_of(spark, rows), shards=4).toPandas()
    check_law(got, 4, 2)


def test_rounds_end_loudly(spark, monkeypatch):
    monkeypatch.setattr(splitters, "MOST_ROUNDS", 1)
    monkeypatch.setattr(splitters, "KEYS_PER_RANGE", 0.01)
    with pytest.raises(RuntimeError, match="overfull"):
        splitters.shard(docs_of(spark, [(i, "t" * (i % 50), None) for i in range(3000)]))


def test_archives_come_back(spark):
    big, small = "große Seite " * 20, "short"
    rows = [(5, "http://a", big), (2, "http://b", big), (9, None, big), (1, "u", small), (3, "u", small), (4, "u", None),
            (None, "u", big), (2, "http://b", big), (6, "u", "y" * 100), (7, "u", "y" * 100), (8, "u", "z" * 99), (10, "u", "z" * 99),
            (11, "u", "v" * 3_000_000)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, digest long, body string")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc_zip.archive_round_trip(pages).collect()), key=str)
    size = len(big.encode())
    want = [(5, size, "revisit", 2), (2, size, "response", None), (9, size, "revisit", 2), (1, 5, "response", None),
            (3, 5, "response", None), (4, 0, "response", None), (None, size, "response", None), (2, size, "response", None),
            (6, 100, "response", None), (7, 100, "revisit", 6), (8, 99, "response", None), (10, 99, "response", None),
            (11, 3_000_000, "response", None)]
    assert got == sorted(want, key=str)
    assert warc_zip.archive_round_trip(pages.where("false")).count() == 0


def test_records_hold_what_was_written_over_several_archives(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>" * (i + 1)) for i in range(60)], "page_id long, url string, html string")
    listed = warc_zip.write_archives(pages.coalesce(2), archive_bytes=2000)
    assert listed.count() > 3 and listed.agg(F.sum("records")).first()[0] == 60
    got = {r.id: (r.url, bytes(r.payload).decode()) for r in warc_zip.read_records(warc_zip.read_indexes(listed)).collect()}
    assert got == {i: (f"http://x/{i}", f"<p>{i}</p>" * (i + 1)) for i in range(60)}


def test_archives_of_the_usual_layout_are_read(spark, tmp_path):
    """Several data files, indexes of three kinds, a comment that holds the end mark, a record that is not gzipped."""
    def record(kind, url, payload):
        return warc_zip.warc_record(kind, url, 5, "d" * 64, payload, 5)

    data, lines = {"a.warc.gz": b"", "b.warc": b""}, []
    for i in range(40):
        name = "a.warc.gz" if i % 3 else "b.warc"
        raw = record("response", f"http://x.org/{i}", f"page {i}".encode() * 9)
        raw = gzip.compress(raw) if name.endswith(".gz") else raw
        lines.append((i, name, len(data[name]), len(raw)))
        data[name] += raw
    cdxj = [f'org,x)/{i} 20240101000000 {json.dumps({"url": f"http://x.org/{i}", "mime": "text/html", "offset": str(o), "length": str(n), "filename": f})}'
            for i, f, o, n in lines]
    old = [f"org,x)/{i} 20240101000000 http://x.org/{i} text/html 200 {'d' * 32} - - {n} {o} {f}" for i, f, o, n in lines]
    path = tmp_path / "usual.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        for name, content in data.items():
            out.writestr(f"archive/{name}", content)
        out.writestr("indexes/first.cdxj", "!meta {}\n" + "\n".join(cdxj[:15]) + "\n")
        out.writestr("indexes/second.cdx.gz", gzip.compress("\n".join(old[15:25]).encode()) + gzip.compress(b"\n" + "\n".join(old[25:30]).encode()))
        out.writestr("indexes/third.cdx", " CDX N b a m s k r M S V g\n" + "\n".join(old[30:]))
        out.writestr("pages/pages.jsonl", "{}")
        out.comment = b"odd PK\x05\x06 comment" + b"." * 30
    listed = warc_zip.archives_of(spark, f"file:{tmp_path}", [str(path)])
    located = warc_zip.read_indexes(listed)
    got = {r.url: (r.id, bytes(r.payload)) for r in warc_zip.read_records(located).collect()}
    assert got == {f"http://x.org/{i}": (None, f"page {i}".encode() * 9) for i in range(40)}


def test_long_ids_beside_missing_ones_come_back(spark, tmp_path):
    big = (1 << 60) + 1
    pages = spark.createDataFrame([(big, "u", "p" * 200), (None, "u v", "q" * 200), (big + 2, "u", "p" * 200)], "page_id long, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc_zip.archive_round_trip(pages.coalesce(1)).collect()}
    assert got == {(big, "response", None), (None, "response", None), (big + 2, "revisit", big)}
    # As Hadoop writes a local URI, and a path without a scheme.
    for folder in (f"file:{tmp_path}/one", f"{tmp_path}/two"):
        listed = warc_zip.write_archives(pages, folder=folder)
        assert warc_zip.read_records(warc_zip.read_indexes(listed)).count() == 3


def test_directories_with_and_without_zip64():
    for wide in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            with archive.open("a", "w", force_zip64=wide) as member:
                member.write(b"first")
            archive.writestr("ü/b", b"second")
            archive.writestr("packed", b"z" * 1000, compress_type=zipfile.ZIP_DEFLATED)
            archive.comment = b"a comment PK"
        data = out.getvalue()
        if wide:
            data = with_zip64_end(data)
        members = {m.name: m for m in warc_zip.read_directory(io.BytesIO(data), len(data))}
        for name, content in (("a", b"first"), ("ü/b", b"second")):
            start = warc_zip.stored_start(io.BytesIO(data), members[name])
            assert data[start : start + members[name].size] == content
        with pytest.raises(ValueError, match="compressed"):
            warc_zip.stored_start(io.BytesIO(data), members["packed"])
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.read_directory(io.BytesIO(b"nothing"), 7)


def with_zip64_end(data):
    """The archive with a ZIP64 end record, a locator and directory entries whose sizes stand in the extra field."""
    end = data.rfind(b"PK\x05\x06")
    count, length, start = struct.unpack_from("<HII", data, end + 10)
    directory, at = b"", start
    for _ in range(count):
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", data, at + 20)
        (header,) = struct.unpack_from("<I", data, at + 42)
        wide = struct.pack("<HHQQQ", 1, 24, plain, packed, header)
        entry = bytearray(data[at : at + 46])
        struct.pack_into("<II", entry, 20, 0xFFFFFFFF, 0xFFFFFFFF)
        struct.pack_into("<H", entry, 30, len(wide))
        struct.pack_into("<H", entry, 32, 0)
        struct.pack_into("<I", entry, 42, 0xFFFFFFFF)
        directory += bytes(entry) + data[at + 46 : at + 46 + names] + wide
        at += 46 + names + extras + comments
    record = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(directory), start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, start + len(directory), 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return data[:start] + directory + record + locator + tail


def slow_links(rows, threshold):
    count, root = [0] * len(rows), list(range(len(rows)))
    unit = [None if v is None or None in v or not np.isfinite(v).all() or not np.any(v) else np.array(v) / np.linalg.norm(v)
            for _, v, _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            (i, u, x), (j, v, y) = rows[a], rows[b]
            if None in (i, j, x, y) or x != y or unit[a] is None or unit[b] is None or len(u) != len(v):
                continue
            if unit[a] @ unit[b] >= threshold:
                count[a] += 1
                count[b] += 1
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = [min((rows[k][0] for k in range(len(rows)) if root[k] == root[i]), default=None) if rows[i][0] is not None else None
             for i in range(len(rows))]
    return sorted(zip([r[0] for r in rows], count, least), key=str)


@pytest.mark.parametrize("most", [4096, 24])
def test_vectors_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(vector_graph, "MOST_SHARD", most)
    monkeypatch.setattr(vector_graph, "LEAST_SHARD", min(most, 256))
    rng = np.random.default_rng(1)
    rows = []
    for g in range(25):
        center = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (center + rng.normal(size=16) * 0.12).astype(np.float32).tolist(), g % 3))
    hot = rng.normal(size=16)
    rows += [(len(rows) + i, (hot + rng.normal(size=16) * 0.05).astype(np.float32).tolist(), 1) for i in range(60)]
    n = len(rows)
    rows += [(n + i, rows[0][1], 0) for i in range(4)]
    rows += [(n + 10, None, 0), (n + 11, [0.0] * 16, 0), (n + 12, [float("nan")] * 16, 0), (n + 13, rows[0][1], None),
             (n + 14, [None] + [1.0] * 15, 0), (n + 15, [float("inf")] * 16, 0), (n + 16, [], 0), (n + 17, [1.0, 2.0], 0),
             (n + 18, [2.0, 4.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, node long")
    got = vector_graph.near_vectors(df)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str)
    true = slow_links(rows, vector_graph.THRESHOLD)
    # A search may miss some links, more so in shards of a few nodes, but never invents any.
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(found, true))
    assert sum(a[1] for a in found) >= (0.99 if most > 24 else 0.9) * sum(b[1] for b in true)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got.collect())
    assert vector_graph.near_vectors(df.where("false")).count() == 0


@pytest.mark.parametrize("beam, rounds", [(1, 1), (24, 3)])
def test_vectors_below_the_target_are_compared_with_all(spark, monkeypatch, beam, rounds):
    monkeypatch.setattr(vector_graph, "MOST_SHARD", 16)
    monkeypatch.setattr(vector_graph, "LEAST_SHARD", 16)
    turn = [np.deg2rad(18 * i) for i in range(3)]
    rows = [(3 * g + i, [float(np.cos(a)), float(np.sin(a))], g) for g in range(20) for i, a in enumerate(turn)]
    draw = np.random.default_rng(3)
    rows += [(100 + i, (draw.normal(size=4)).tolist(), 50) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    search = vector_graph.Search(overlap=1, degree=2, beam=beam)
    got = vector_graph.near_vectors(df, search=search, rounds=rounds, target=1.0, floor=1.0)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str)
    assert found == slow_links(rows, vector_graph.THRESHOLD) and got.first()["recall"] == 1.0


def test_tables_with_hardly_any_links_are_searched_too(spark, monkeypatch):
    """Thousands of vectors that lie apart and a few that link: no comparison of all pairs, and the few are found."""
    def refused(*_):
        raise AssertionError("all pairs were compared")

    monkeypatch.setattr(vector_graph, "exact_links", refused)
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=8).tolist(), 1) for i in range(8000)]
    rows += [(10_000 + i, (np.array(rows[40 * i][1]) * (1 + 1e-3 * draw.normal(size=8))).tolist(), 1) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for threshold, links in ((0.9999, 24), (1 - 1e-10, 0)):
        got = vector_graph.near_vectors(df, threshold=threshold).toPandas()
        assert got["recall"].iloc[0] >= 0.9 and abs(got["n_links"].sum() - links) <= 0.1 * links
        low = got["recall_low"].iloc[0]
        assert 0.5 <= low <= got["recall"].iloc[0] if links else np.isnan(low)


@pytest.mark.parametrize("key", ["op1_quality_zstd", "op4_langid", "op9_toxicity_zstd"])
def test_registered_scores_cover_the_table(spark, key):
    got = entries.QUERIES[key](spark, SF).toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and got["score"].between(0, 1).all()


def test_similar_rows_go_only_beside_one_that_stays(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(3000)]

    def text(n):
        return [vocabulary[i] for i in rng.integers(0, 3000, n)]

    rows, base = [], [text(120) for _ in range(60)]
    for b in base:
        rows.append(" ".join(b))
        for share in (0.0, 0.01, 0.02, 0.1):
            changed = [w if rng.random() > share else "other" + str(rng.integers(1000)) for w in b]
            rows.append(" ".join(changed))
    rows += [" ".join(base[0]).upper(), "  ".join(base[1])] + ["copies of one text"] * 300 + [None, "", " \t", "short", "short"]
    # A group in which every text is near the first and few are near each other.
    rows += [" ".join(w if rng.random() > 0.015 else f"z{rng.integers(9999)}" for w in base[2]) for _ in range(80)]
    given = [(i if i % 11 else None, t, "en", "s", 1, 2, "x", "y") for i, t in enumerate(rows)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, row string, hit_key string")
    kept = simhash_trie.distinct_similar_rows(docs.repartition(6))
    assert kept.columns == docs.columns
    sets = [frozenset(simhash_trie.shingle_hashes(r[1], 5).tolist()) for r in given]
    stays = [frozenset(simhash_trie.shingle_hashes(r.text, 5).tolist()) for r in kept.collect()]
    # One row for each set of shingles that stays, and a similar one for each that goes.
    assert len(stays) == len(set(stays)) and set(stays) <= set(sets)

    def similarity(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    gone = set(sets) - set(stays)
    assert len(gone) > 60 and all(max(similarity(g, s) for s in stays) >= 0.8 for g in gone)
    near = [(a, b) for i, a in enumerate(stays) for b in stays[:i] if similarity(a, b) >= 0.85]
    assert len(near) <= 0.05 * len(gone)
    ids = {frozenset(simhash_trie.shingle_hashes(r.text, 5).tolist()): r.doc_id for r in kept.collect()}
    assert all(i == min((r[0] for r, s in zip(given, sets) if s == k and r[0] is not None), default=None) for k, i in ids.items())
    assert simhash_trie.distinct_similar_rows(docs.where("false")).count() == 0


@pytest.mark.parametrize("leaders, pairs_a_key, id_rounds", [(simhash_trie.LEADERS, 16, 40), (0, 0, 40), (1, 16, 2)])
def test_every_similar_member_of_a_group_goes_whatever_the_leaders(spark, monkeypatch, leaders, pairs_a_key, id_rounds):
    """More families than leaders, a chain in the order of its ids, unlike texts of common shingles: one group."""
    monkeypatch.setattr(simhash_trie, "PAIRS_A_KEY", pairs_a_key)
    monkeypatch.setattr(simhash_trie, "ID_ROUNDS", id_rounds)
    rng = np.random.default_rng(5)
    sets = [set(range(1000 * f, 1000 * f + 40)) for f in range(20)]
    sets += [(s - set(rng.choice(sorted(s), 3))) | {10**6 + i} for i, s in enumerate(sets * 6)]
    sets += [set(range(50_000 + 3 * i, 50_040 + 3 * i)) for i in range(24)]
    sets += [set(range(70_000, 70_020)) | set(range(80_000 + 100 * i, 80_012 + 100 * i)) for i in range(30)]
    # Just the limit: 4 of 5, and 35 of 43 with 28 of 35 beside it.
    sets += [{90_000, 90_001, 90_002, 90_003}, {90_000, 90_001, 90_002, 90_003, 90_004}, set(range(91_000, 91_035)), set(range(91_000, 91_028))]
    order = rng.permutation(len(sets))
    order[140:164] = np.sort(order[140:164])
    # Nodes are numbered in another order than ids; some have no id.
    rows = [(int(i), 0, bool(i % 7 == 0), None if i % 7 == 0 else 1000 - int(i), sorted(s)) for i, s in zip(order, sets)]
    rows += [(5000 + n, 1, False, n, list(range(n % 2, 30))) for n in range(4)]
    members = spark.createDataFrame(rows, "node long, component long, no_id boolean, least long, shingles array<long>")
    got = {r.node: r.leader for r in simhash_trie.covered_nodes(members.repartition(5), 0.8, leaders).collect()}

    def similarity(a, b):
        return len(a & b) / len(a | b)

    stay, gone = [], set()
    for node, component, no_id, least, shingles in sorted(rows, key=lambda r: (r[2], r[3] or 0, r[0])):
        if any(c == component and similarity(set(shingles), s) >= 0.8 for _, c, s in stay):
            gone.add(node)
        else:
            stay.append((node, component, set(shingles)))
    if id_rounds > 2:
        assert set(got) == gone
    of = {r[0]: (r[1], set(r[4])) for r in rows}
    left = sorted(set(of) - set(got))
    assert all(n in left and of[n][0] == of[g][0] and similarity(of[n][1], of[g][1]) >= 0.8 for g, n in got.items())
    assert not any(of[a][0] == of[b][0] and similarity(of[a][1], of[b][1]) >= 0.8 for a in left for b in left if a < b)


def test_near_copies_just_below_the_limit_are_not_met_pair_by_pair(spark, monkeypatch):
    """A group of near copies of one text, most unlike each other, subsets and texts at the limit among them."""
    rng = np.random.default_rng(11)
    base, sets = np.arange(150), []
    for i in range(400):
        taken = {int(k) for start in rng.choice(146, int(rng.integers(3, 9)), replace=False) for k in range(start, start + 5)}
        sets.append((set(base.tolist()) - taken) | {10**6 + 1000 * i + k for k in taken})
    sets += [set(sorted(s)[:-5]) for s in sets[:20]] + [set(sorted(s)[: -(len(s) // 5)]) for s in sets[20:40]]
    sets += [set(sorted(s)[: -(len(s) // 5) - 1]) for s in sets[40:60]]
    rows = [(i, 0, False, int(j), sorted(s)) for i, (j, s) in enumerate(zip(rng.permutation(len(sets)), sets))]
    members = spark.createDataFrame(rows, "node long, component long, no_id boolean, least long, shingles array<long>")
    met, verified = [], simhash_trie.verified

    def counted(pairs, *rest):
        met.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash_trie, "verified", counted)
    found = simhash_trie.covered_by_pairs(members.repartition(5), 0.8)
    stay, gone = [], set()
    for node, *_, shingles in sorted(rows, key=lambda r: r[3]):
        if any(len(s & set(shingles)) / len(s | set(shingles)) >= 0.8 for s in stay):
            gone.add(node)
        else:
            stay.append(set(shingles))
    assert 40 <= len(gone) < 200 and {r.node for f in found for r in f.collect()} == gone
    assert sum(met) <= 4 * len(rows)


def test_repeats_within_a_text_neither_make_nor_hide_candidates(spark, monkeypatch):
    """Unlike texts that repeat one line form no group; a near copy that repeats a passage of its text goes."""
    rng = np.random.default_rng(7)

    def words(n):
        return " ".join(f"w{k}" for k in rng.integers(0, 10**9, n))

    line, text = words(8), words(200)
    rows = [(i, f"{line} " * 60 + words(40), "s") for i in range(30)]
    rows += [(50, text, "s"), (51, f"{text} " + " ".join([" ".join(text.split()[90:110])] * 40), "s")]
    groups, covered = [], simhash_trie.covered_nodes

    def counted(members, *rest):
        groups.append(members.count())
        return covered(members, *rest)

    monkeypatch.setattr(simhash_trie, "covered_nodes", counted)
    kept = simhash_trie.distinct_similar_rows(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in rows[:-1]] and groups == [2]


def odd_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, None, None, None, None), (-1, "", None, "s", 0), (-2, "12 !!", "en", None, 5), (-3, "w " * 100_000, None, None, 9)]
    extra = spark.createDataFrame(rows, docs.schema).union(docs.limit(3))
    return docs.union(extra).withColumns({"shard": F.lit(1), "Slot": F.lit("s"), "bits": F.lit(0), "found": F.lit(2), "hit_key": F.lit("h"), "a.b": F.lit(3), "row": F.lit(1)})


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    docs, sizes = odd_documents(spark), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes[name] = docs.count()
        if name != "sharding":
            assert docs.columns == columns
    assert docs.columns == columns + ["shard_", "slot_"]
    assert sizes["language"] >= 200 and sizes["near_duplicates"] < sizes["language"]
    assert sizes["decontamination"] > 0.9 * sizes["near_duplicates"] and sizes["sharding"] == sizes["mixing"]


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_centroids_that_would_link_are_thinned():
    draw = np.random.default_rng(5)
    group = draw.normal(size=8) + 0.01 * draw.normal(size=(1500, 8))
    table = vector_graph.unit_rows(np.concatenate([group, draw.normal(size=(700, 8))])).astype(np.float32)
    stay = vector_graph.apart(table, 0.93)
    close = table @ table[stay].T
    assert stay[0] == 0 and (stay < 1500).sum() == 1
    assert (close.max(axis=1) >= 0.93).all()
    between = close[stay]
    np.fill_diagonal(between, -1)
    assert between.max() < 0.93
    assert len(vector_graph.apart(table[:0], 0.93)) == 0
