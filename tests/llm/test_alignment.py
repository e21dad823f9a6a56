import hashlib
from collections import Counter

from vitrina.llm import alignment
from vitrina.llm.queries import vocab_path

from .conftest import make_docs

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocab_path())
    a.encode_special_tokens = True
    a.no_padding()
    a.no_truncation()
    return a, sentencepiece.SentencePieceProcessor(model_file=vocab_path("piece_bpe_32k.model"))


def byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def brute(texts):
    """Rows without doc_id, from the libraries and plain loops."""
    a_lib, b_lib = tokenizers()
    back = byte_letters()

    def b_bytes(k):
        piece = b_lib.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(k) else piece.replace("▁", " ").encode()

    groups, counts = [], Counter()
    for text in texts:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_parts = [bytes(back[c] for c in a_lib.id_to_token(k)) for k in a]
        b_parts = [b_bytes(k) for k in b]
        if not text or {b"".join(a_parts), b"".join(b_parts)} != {(" " + text).encode()}:
            groups.append([])
            continue

        def ends(parts):
            at, out = 0, {}
            for k, p in enumerate(parts):
                at += len(p)
                out[at] = k + 1
            return out

        ea, eb = ends(a_parts), ends(b_parts)
        own, pa_, pb = [], 0, 0
        for end in sorted(ea.keys() & eb.keys()):
            own.append((a[pa_: ea[end]], b[pb: eb[end]]))
            pa_, pb = ea[end], eb[end]
        groups.append(own)
        counts.update({(x, y) for g, h in own for x in set(g) for y in set(h)})
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    rows = []
    for own in groups:
        n_links = best = total = 0
        for g, h in own:
            cg, ch = Counter(g), Counter(h)
            n_links += len(g) * len(h)
            for x, m in cg.items():
                for y, k in ch.items():
                    total += m * k * counts[x, y]
                    best += m * k * (counts[x, y] == top[x])
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in own)
        rows.append((sum(len(g) for g, _ in own), sum(len(h) for _, h in own), len(own), n_links, best, total, hashlib.sha256(text.encode()).hexdigest() if own else ""))
    return rows


def scores(docs):
    got = alignment.alignment_scores(docs, vocab_path(), vocab_path("piece_bpe_32k.model"))
    return sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)


def expected(rows):
    return sorted(((i, *r) for (i, _), r in zip(rows, brute([t or "" for _, t in rows]))), key=str)


def test_edge_rows_equal_brute_force(spark, edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert scores(edge_docs) == expected(rows)


def test_empty_table(spark, no_docs):
    assert scores(no_docs) == []


def test_given_documents_equal_brute_force_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 3_000)
    monkeypatch.setattr(alignment, "HELD_COUNTS", 500)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert scores(docs.repartition(5)) == expected(rows)


ODD = ["zxqjkvw" * 40, "é" * 300, "ﬁ ligature", "▁ mark", "a  b", "<s> </s> <unk> <0x41> <|endoftext|>", "\U0001f9ff\U00020000 ok", "\ufffd", "ÅÅÅ A\u030a", "the the the", "x\x00y", "\u200b", "éé"]


def test_special_strings_and_odd_characters(spark):
    rows = list(enumerate(ODD))
    assert scores(make_docs(spark, rows)) == expected(rows)


def test_long_groups_and_small_blocks_give_the_same_links(monkeypatch):
    pieces = alignment.both_tokenizers(vocab_path(), vocab_path("piece_bpe_32k.model"))
    texts = ODD + ["", "one two three", "zxqjkvwzxqj" * 90]
    batch = alignment.align_block(pieces, list(range(len(texts))), texts)

    def found():
        out = Counter()
        for lo, _, flats, lasts, docs in alignment.aligned_blocks([batch.filter(batch.column("n_a").to_numpy() > 0)]):
            group, pair, n = alignment.links(flats, lasts)
            for d, p, m in zip((docs[group] + lo).tolist(), pair.tolist(), n.tolist()):
                out[d, p] += m
        return out

    want = found()
    assert sum(want.values()) == sum(batch.column("n_links").to_pylist())
    for long, tokens in ((1, 600_000), (0, 100), (1 << 40, 300)):
        monkeypatch.setattr(alignment, "LONG_GROUP", long)
        monkeypatch.setattr(alignment, "BLOCK_TOKENS", tokens)
        assert found() == want


def test_very_long_text(spark):
    rows = [(1, "word " * 40_000 + "end"), (2, "q" * 100_000), (3, "k" * 5 + " " * 30_000 + "k"), (4, "zxqjkvw " * 5_000)]
    assert scores(make_docs(spark, rows)) == expected(rows)
