import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from placewright.llm import packing, token_count
from placewright.llm._tokens import Encoder

WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer_on_whole_texts():
    import pyarrow as pa

    texts = ["", None, "  ", "it's <|endoftext|>a b's É.È, İstanbul ΣΑΣ Σ naïve áb 123 a,b ½ don't... .", "A\x1cB\x85C d e", "ß Straße, ÀÉ.", "一二 三", "x" * 5000]
    ids, bounds = Encoder.load("word_bpe_49k.json").encode(pa.array(texts), 1)
    assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(len(texts))] == [[*ids_of(t), 1] for t in texts]


@pytest.mark.parametrize("seq_len,packet", [(2048, 512), (64, 50), (7, 100)])
def test_every_id_lies_in_one_piece_and_sequences_are_full(awkward, seq_len, packet):
    rows = packing.pack(awkward, seq_len=seq_len, packet=packet).collect()
    texts = defaultdict(list)
    for r in awkward.collect():
        texts[r.doc_id].append([*ids_of(r.text), 1])
    by_sequence = defaultdict(list)
    by_doc = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, own in by_sequence.items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert sum(r.length for r in own) == seq_len or k == len(by_sequence) - 1
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        if len(texts[doc_id]) == 1:
            own.sort(key=lambda r: r.start)
            assert sum((r.ids for r in own), []) == texts[doc_id][0]
            assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert sum(r.length for r in own) == sum(map(len, texts[doc_id]))


def drr(queues, quanta):
    """Plain deficit round-robin over backlogged queues of packet sizes."""
    order, deficit, at = [], {q: 0.0 for q in queues}, {q: 0 for q in queues}
    while any(at[q] < len(queues[q]) for q in queues):
        for q in queues:
            deficit[q] += quanta[q]
            while at[q] < len(queues[q]) and queues[q][at[q]] <= deficit[q] + 1e-9:
                deficit[q] -= queues[q][at[q]]
                order.append((q, at[q]))
                at[q] += 1
    return order


def test_order_is_that_of_deficit_round_robin(spark):
    rng = np.random.default_rng(3)
    rows, sizes = [], {}
    for q in ("a", "b", "c"):
        sizes[q] = [int(x) for x in rng.integers(1, 40, 30)]
        rows += [(0, i, q, 0, n) for i, n in enumerate(sizes[q])]
    packets = spark.createDataFrame(rows, "part int, row long, queue string, start long, n int").coalesce(1)
    total = {q: sum(x) for q, x in sizes.items()}
    queues = sorted(total, key=lambda q: (-total[q], q))
    got = packing.plan(packets, 32, None)
    # (row, n, queue) pairs are found back by their place in the stream
    want = drr({q: sizes[q] for q in queues}, {q: total[q] / sum(total.values()) * 32 for q in queues})
    at = np.cumsum([0, *[sizes[q][i] for q, i in want]])[:-1].tolist()
    assert sorted((r.at, r.row, r.n) for r in got.collect()) == sorted((a, i, sizes[q][i]) for a, (q, i) in zip(at, want))


def test_mixture_is_held_within_a_packet_and_a_quantum(awkward):
    rows = sorted(packing.pack(awkward, seq_len=256, packet=64).collect(), key=lambda r: (r.sequence_id, r.offset))
    total = defaultdict(int)
    for r in rows:
        total[r.source] += r.length
    n, seen, done = sum(total.values()), defaultdict(int), 0
    for r in rows:
        seen[r.source] += r.length
        done += r.length
        for s in total:
            assert abs(seen[s] - done * total[s] / n) <= 2 * (64 + 256)


def test_weights_and_empty(awkward, nothing):
    rows = packing.pack(awkward, weights={"s0": 0.9}).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in awkward.collect()}
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("queues", [1, 200_000])
def test_more_than_1024_sources_keep_their_names_and_weights(spark, monkeypatch, queues):
    monkeypatch.setattr(packing, "QUEUES", queues, raising=True)
    rows = [(i, f"word {i}", f"host{i}") for i in range(1100)] + [(5000 + i, "some more words here", "late") for i in range(40)] + [(9000, "none", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = packing.pack(docs, seq_len=64, weights={"late": 0.9}).collect()
    assert {(r.doc_id, r.source) for r in got} == {(i, s) for i, _, s in rows}
    # the heavy source is through before a tenth of the others
    last = max(r.sequence_id for r in got if r.source == "late")
    assert sum(r.length for r in got if r.source != "late" and r.sequence_id < last) < 0.4 * sum(r.length for r in got)
    assert {r.sequence_id for r in got if r.source == "late"} <= set(range(len({r.sequence_id for r in got}) // 2))


@pytest.mark.parametrize("block", [16, 1000, 1 << 18])
def test_separator_scan_gives_lengths_whatever_the_block(awkward, nothing, block):
    got = sorted((str(r.doc_id), r.n_tokens) for r in token_count.count_tokens(awkward, block=block).collect())
    assert got == sorted((str(r.doc_id), len(ids_of(r.text))) for r in awkward.collect())
    assert token_count.count_tokens(nothing, block=block).count() == 0


def test_scan_of_raw_blocks_with_open_end(spark):
    end, rng = 9, np.random.default_rng(1)
    rows, want = [], []
    for f in range(4):
        ids = rng.integers(0, 12, 500)
        if f == 3:
            ids[:] = 5  # a file without any end
        cuts = [0, *sorted(rng.integers(0, 500, 20).tolist()), 500]
        rows += [(f, k, ids[a:b].astype("<u2").tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        start = 0
        for i in np.flatnonzero(ids == end):
            want.append((f, start, int(i - start)))
            start = int(i) + 1
        if start < 500:
            want.append((f, start, 500 - start))
    got = token_count.scan(spark.createDataFrame(rows, "file int, block long, data binary"), end=end)
    assert sorted((r.file, r.start, r.n_tokens) for r in got.collect()) == sorted(want)


def test_no_id_of_a_text_is_lost_to_the_separator(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["a <|endoftext|> b", "", "plain words", "<|endoftext|><|endoftext|>"]
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block=3).collect()}
    assert got == {i: len(whole.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
