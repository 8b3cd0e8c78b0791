from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from ridelake.llm.common import mixed, pieces_of, text_bytes
from ridelake.llm.piece_sampling import decode, encode, encoded, lattice, op2_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_round_trip(texts, odd_texts, documents):
    for df in (texts(odd_texts), documents):
        want = sorted((repr(r.doc_id), r.text or "") for r in df.select("doc_id", "text").collect())
        assert sorted((repr(r.doc_id), r.text) for r in decode(encode(df, PATH), PATH).collect()) == want


def test_the_library_decodes_to_the_text(documents):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = {r.doc_id: r.text for r in documents.collect()}
    for r in encode(documents, PATH).collect():
        assert model.decode(list(r.ids)) == rows[r.doc_id]


def test_sampling_follows_the_weights():
    model = lattice(PATH, 1.0)
    word, size = "there", 60000
    data, offsets = text_bytes(pa.array([word] * size))
    ids, at = encoded(model, data, offsets, mixed(np.arange(size, dtype=np.uint64)))
    got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True))

    def paths(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            piece = model.words.id_of.get(rest[:k])
            if piece is not None:
                for path, weight in paths(rest[k:]):
                    yield (piece, *path), weight + model.weight[piece]

    want = dict(paths(" " + word))
    total = sum(map(math.exp, want.values()))
    assert set(got) <= set(want)
    assert max(abs(got[p] / size - math.exp(w) / total) for p, w in want.items()) < 0.01


def test_reproducible_whatever_the_layout(documents):
    one = {r.doc_id: r.ids for r in encode(documents.repartition(7), PATH, seed=3).collect()}
    two = {r.doc_id: r.ids for r in encode(documents.coalesce(1), PATH, seed=3).collect()}
    other = {r.doc_id: r.ids for r in encode(documents, PATH, seed=4).collect()}
    assert one == two and one != other


def test_chunks_do_not_matter(documents):
    model, column = lattice(PATH, 1.0), pa.array([r.text for r in documents.collect()])
    keys = mixed(np.arange(len(column), dtype=np.uint64))
    runs = [
        np.concatenate([encoded(model, d, o, keys[low:high])[0] for low, high, d, o in pieces_of(column, size)])
        for size in (1000, 1 << 20)
    ]
    assert (runs[0] == runs[1]).all()


def test_query(texts, odd_texts):
    rows = op2_sentencepiece(texts(odd_texts), PATH).collect()
    assert len(rows) == len(odd_texts) and all(r.lossless for r in rows)
    got = sorted((repr(r.doc_id), r.decoded_sha256) for r in rows)
    assert got == sorted((repr(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in odd_texts)
    assert next(r.n_pieces for r in rows if r.doc_id == 1) == 0
    assert op2_sentencepiece(texts([]), PATH).count() == 0
