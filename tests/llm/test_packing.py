import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ranktrail.llm import bestfit, packing
from ranktrail.llm.tokens import cuts, default_vocabulary, encoder
from tests.llm.brute import documents

TEXTS = [
    None,
    "",
    " ",
    "  two  spaces ",
    "don't say 's\n\n it\x1c's <|endoftext|> é\u3000ß 12 1 !?",
    "long word " * 3000,
    "same text",
    "same text",
    "x" * 5000,
    *(f"number {i} " * (i % 90) for i in range(150)),
]


@pytest.fixture(scope="module")
def ids():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*whole.encode(t or "", add_special_tokens=False).ids, 0] for t in TEXTS]


def test_encoder_agrees_with_the_library(ids):
    encode = encoder(default_vocabulary()).encode
    assert [encode(t or "").tolist() for t in TEXTS] == [i[:-1] for i in ids]
    draw = random.Random(1)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2000):
        text = "".join(draw.choice(" \n\t'srve1!\x1c é.\u3000d") for _ in range(draw.randint(0, 40)))
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_only_the_first_piece_is_short():
    assert cuts(1, 4) == [(0, 1)] and cuts(4, 4) == [(0, 4)]
    assert cuts(5, 4) == [(0, 1), (1, 4)] and cuts(8, 4) == [(0, 4), (4, 4)]


def test_capacity_tree_finds_the_tightest():
    tree, have, draw = packing.CapacityTree(30), [], random.Random(2)
    for _ in range(500):
        if have and draw.random() < 0.5:
            gone = have.pop(draw.randrange(len(have)))
            tree.add(gone, -1)
        else:
            have.append(draw.randint(1, 30))
            tree.add(have[-1], 1)
        size = draw.randint(1, 30)
        assert tree.tightest(size) == min((c for c in have if c >= size), default=-1)


def _plain_best_fit(sizes, width):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b in bins if width - sum(sizes[j] for j in b) >= sizes[i]]
        if fits:
            min(fits, key=lambda b: width - sum(sizes[j] for j in b)).append(i)
        else:
            bins.append([i])
    return len(bins)


def test_both_packers_are_best_fit():
    draw = random.Random(3)
    for _ in range(40):
        sizes = [draw.randint(1, 50) for _ in range(draw.randint(1, 60))]
        bins = packing.best_fit_decreasing(sizes, 50)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
        place, offset = bestfit.best_fit(sizes, 50)
        used = {}
        for b, o, s in sorted(zip(place, offset, sizes, strict=True)):
            assert used.get(b, 0) == o
            used[b] = o + s
        assert max(used.values()) <= 50
        assert len(bins) == len(used) == _plain_best_fit(sizes, 50)


def test_packed_ids_round_trip(spark, ids, tmp_path):
    docs = documents(spark, TEXTS).withColumnRenamed("lang", "ids")
    packing.write_packed(packing.pack_documents(docs, width=256, window_tokens=9000), str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    found = {}
    for r in rows:
        matrix = packing.id_matrix([r.ids], 256)
        assert matrix.shape == (1, 256) and r.n_tokens == r.cu_seqlens[-1] <= 256
        assert not matrix[0, r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1]
        position = packing.positions(r.cu_seqlens)
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert position[a] == 0 and position[b - 1] == b - a - 1
            found[r.doc_ids[k], r.pieces[k]] = (r.starts[k], matrix[0, a:b].tolist())
    for doc_id, expected in enumerate(ids):
        pieces = sorted((p, v) for (d, p), v in found.items() if d == doc_id)
        assert [p for p, _ in pieces] == list(range(len(pieces)))
        assert [x for _, (_, part) in pieces for x in part] == expected
        assert all(len(part) == 256 for _, (_, part) in pieces[1:])


def _check_placement(rows, ids, width):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, expected in enumerate(ids):
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.piece):
            data = np.array(expected[at : at + r.length], "<u4").tobytes()
            assert r.start == at and zlib.crc32(data) == r.ids_crc32
            at += r.length
        assert at == len(expected)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= width
    return len(by_sequence)


def test_pieces_are_placed_without_gaps(spark, ids):
    rows = bestfit.pack_best_fit(documents(spark, TEXTS), width=256).collect()
    n = _check_placement(rows, ids, 256)
    assert n <= 1.02 * sum(map(len, ids)) / 256 + 1


def test_rounds_merge_what_groups_leave(spark):
    draw = random.Random(4)
    sizes = [draw.randint(1, 90) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    placed = bestfit.place_items(items, width=256, group_items=100, nearly_full=2).collect()
    used = {}
    for r in sorted(placed, key=lambda r: (r.bin, r.offset)):
        assert used.get(r.bin, 0) == r.offset
        used[r.bin] = r.offset + sizes[r.item]
    assert len(placed) == 3000 and max(used.values()) <= 256
    assert len(used) <= 1.02 * sum(sizes) / 256 + 1


def test_items_that_cannot_merge_end_the_rounds(spark):
    items = spark.range(500).selectExpr("id AS item", "200L AS size")
    placed = bestfit.place_items(items, width=256, group_items=50)
    assert placed.select("bin").distinct().count() == 500


def test_empty_table_and_null_ids(spark):
    empty = documents(spark, ["x"]).limit(0)
    assert bestfit.pack_best_fit(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    odd = documents(spark, ["a b", "a b"]).selectExpr("CAST(NULL AS long) AS doc_id", "text")
    odd = odd.coalesce(1)
    assert [r.doc_id for r in bestfit.pack_best_fit(odd).collect()] == [None, None]
    assert packing.pack_documents(odd).first().doc_ids == [None, None]


def test_token_pieces_hold_few_texts_at_once(spark, monkeypatch):
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, ddl):
            return run

    class Task:
        def partitionId(self):
            return 0

    encoded = []

    class Encoder:
        def encode(self, text):
            encoded.append(text)
            return np.arange(3, dtype=np.uint32)

    monkeypatch.setattr(bestfit.TaskContext, "get", staticmethod(Task))
    monkeypatch.setattr(bestfit, "encoder", lambda path: Encoder())
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(5_000), pa.int64()), "text": ["a"] * 5_000})
    out = bestfit.token_pieces(Docs(), vocabulary="")([batch])
    assert len(next(out)) == len(encoded) <= 1_000
    assert sum(len(part) for part in out) + 500 == 5_000 == len(encoded)
