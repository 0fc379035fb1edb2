"""Alignment against whole texts given to both libraries, and brute force over all links."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from croptide.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string"
FILES = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def tokens(text, libraries):
    """Ids and byte ends of both, or None where they don't give back blank and text."""
    a, b = libraries
    if not text:
        return None
    # The byte-level alphabet by the library's own decoder, one token at a time.
    table = alignment.byte_level_table()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_parts = [bytes(table[c] for c in a.id_to_token(i)) for i in a_ids]
    b_parts = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, b.id_to_piece(i)) for i in b_ids)]
    whole = (" " + text).encode()
    if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
        return None
    spans = []
    for ids, parts in ((a_ids, a_parts), (b_ids, b_parts)):
        at, out = 0, []
        for i, p in zip(ids, parts, strict=True):
            out.append((i, at, at + len(p)))
            at += len(p)
        spans.append(out)
    return spans


def brute(rows, libraries):
    coded = [(i, tokens(t, libraries)) for i, t in rows]
    held, out = Counter(), []
    links = []
    for _, spans in coded:
        found = []
        if spans:
            found = [(a, b) for a, x, y in spans[0] for b, u, v in spans[1]
                     if max(x, u) < min(y, v)] if len(spans[0]) < 3000 else fast(spans)
        links.append(found)
        held.update(set(found))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    for (i, spans), found in zip(coded, links, strict=True):
        if not spans:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({y for _, _, y in spans[0]} & {v for _, _, v in spans[1]})
        names, lo = [], 0
        sides = [dict.fromkeys(cuts) for _ in range(2)]
        for side, own in zip(sides, spans, strict=True):
            rest = iter(own)
            for cut in cuts:
                part = []
                for t, _, y in rest:
                    part.append(str(t))
                    if y == cut:
                        break
                side[cut] = ",".join(part)
        names = [f"{sides[0][c]}|{sides[1][c]}" for c in cuts]
        out.append((i, len(spans[0]), len(spans[1]), len(cuts), len(found),
                    sum(held[p] == best[p[0]] for p in found), sum(held[p] for p in found),
                    hashlib.sha256(";".join(names).encode()).hexdigest()))
    return out


def fast(spans):
    out, j = [], 0
    for a, x, y in spans[0]:
        while spans[1][j][2] <= x:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][1] < y:
            out.append((a, spans[1][k][0]))
            k += 1
    return out


def texts():
    rng = random.Random(11)
    parts = ["a", "The", "é", "é", "ß", "中", "文字", "12", "½", "'s", "'LL", " ", " ", " ", "  ",
             "\n", "\t", "\xa0", "　", " ", "\x85", "\x1c", "<|endoftext|>", "<s>", "</s>",
             "<unk>", "<0x0A>", "▁", "👍🏽", "́", "-", "...", "“", "°", "\x00", "\x7f", "ing", "﷽"]
    fixed = [None, "", " ", "  ", "\n", "a", " a", "a ", "▁", "a▁b", "<|endoftext|> <s>", "x" * 9000,
             "word " * 2000, "中文 中文", "a\x85 b", "été ° à", "naïve café\xa0 bar"]
    return fixed + ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(500)]


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def test_matches_whole_texts(spark, libraries, monkeypatch):
    rows = [*enumerate(texts()), (None, "a b"), (5, "a"), (5, "a")]
    want = sorted(brute(rows, libraries), key=key)
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    got = alignment.link_statistics(frame, *FILES)
    assert got.columns == ["doc_id", *COLUMNS]
    assert sorted(map(tuple, got.collect()), key=key) == want
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 900)  # many blocks share pairs
    assert sorted(map(tuple, alignment.link_statistics(frame, *FILES).collect()), key=key) == want
    assert sum(r[1] > 0 for r in want) > 200
    assert sum(r[1] == 0 for r in want) > 30


def test_matches_on_the_tables(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = alignment.link_statistics(docs, *FILES)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, libraries))


def test_groups_give_back_the_text(spark):
    rows = [(1, "Naïve  words,\nand 中文 12"), (2, ""), (3, "a▁b"), (None, "x")]
    got = {r["doc_id"]: r["groups"] for r in alignment.alignments(
        spark.createDataFrame(rows, DOCS), *FILES).collect()}
    assert got[2] == got[3] == []
    whole = b" " + rows[0][1].encode()
    assert got[1][0]["start"] == 0 and got[1][-1]["end"] == len(whole)
    assert all(x["end"] == y["start"] for x, y in zip(got[1], got[1][1:], strict=False))
    stats = {r["doc_id"]: r for r in alignment.link_statistics(
        spark.createDataFrame(rows, DOCS), *FILES).collect()}
    for i, groups in got.items():
        text = ";".join(f"{','.join(map(str, g['a']))}|{','.join(map(str, g['b']))}"
                        for g in groups)
        assert stats[i]["groups_sha256"] == (
            hashlib.sha256(text.encode()).hexdigest() if groups else "")


def test_pieces_are_encoded_once(monkeypatch):
    """Each piece goes to the libraries once, until it is not among those used last."""
    with open(FILES[0], encoding="utf-8") as a, open(FILES[1], "rb") as b:
        files = a.read(), b.read()
    rng = random.Random(5)
    vocabulary = [f" {''.join(rng.choices('abcdé', k=4))}{k}".encode() for k in range(90)]
    odd = [b" a  b", "\n中文".encode(), " ▁".encode(), b" \xff"]
    coder, seen = alignment.Pieces(*files), []
    inner = coder._ids
    monkeypatch.setattr(coder, "_ids", lambda text: seen.append(text) or inner(text))
    keys = vocabulary[:50] * 3
    made = coder.encode(keys)
    assert "".join(seen).encode() == b"".join(vocabulary[:50])
    pieces, at = made
    assert pieces.texts[at[0]] == pieces.texts[at[50]]
    coder.encode(vocabulary[:50])
    assert len("".join(seen).encode()) == len(b"".join(vocabulary[:50]))
    with monkeypatch.context() as broken:  # no run gives back its bytes
        broken.setattr(coder, "_run", lambda keys: None)
        pieces, at = coder.encode(vocabulary[50:55])
        assert pieces.counts[at, 2].all()
        seen.clear()
        coder.encode(vocabulary[50:55])
        assert not seen

    # Whatever is remembered and forgotten, a piece is what it is alone.
    monkeypatch.setattr(alignment, "PIECE_CACHE", 40)
    monkeypatch.setattr(alignment, "RUN", 7)
    alone = {}
    for k in [*vocabulary, *odd]:
        pieces, at = coder.encode([k])
        alone[k] = pieces.take(at)
    for _ in range(30):
        asked = rng.choices([*vocabulary, *odd], k=25)
        pieces, at = coder.encode(asked)
        assert len(coder.place) == len(pieces.counts) - len(
            {k for k in asked if k not in coder.place}) <= 40 + 25
        for k, own in zip(asked, at, strict=True):
            want, got = alone[k], pieces.take(np.array([own]))
            assert got.texts == want.texts
            assert got.counts.tolist() == want.counts.tolist()
            assert got.links.tolist() == want.links.tolist()
    first = coder.encode(asked)[1]
    seen.clear()
    coder.encode([k for k in asked if k in coder.place])
    assert not seen and len(first) == 25


def test_division_finds_all_shared_ends():
    rng = random.Random(3)
    for _ in range(500):
        n = rng.randrange(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n), rng.randrange(n)), n}))
                for _ in range(2))
        in_a, in_b = alignment.shared_ends(a, b)
        assert a[in_a].tolist() == b[in_b].tolist() == sorted(set(a) & set(b))
        x, y = alignment.overlaps(a, b)
        starts = [np.append(0, e)[:-1] for e in (a, b)]
        assert list(zip(x.tolist(), y.tolist(), strict=True)) == [
            (i, j) for i in range(len(a)) for j in range(len(b))
            if max(starts[0][i], starts[1][j]) < min(a[i], b[j])]


def test_empty_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 3, "x")], DOCS + ", block int, pairs string")
    assert alignment.link_statistics(frame, *FILES).first()["n_a"] == 2
    assert alignment.link_statistics(frame.limit(0), *FILES).count() == 0
    nulls = spark.createDataFrame([(None, None), (2, None)], DOCS)
    assert sorted(r["n_links"] for r in alignment.link_statistics(nulls, *FILES).collect()) == [0, 0]
