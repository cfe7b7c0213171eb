"""The parts of the operators that need no Spark, against brute force."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest

from textloom.llm import ann, bpe, html, langid, packing, simhash, suffix, tokenfile, tokens

ODD = "abΣςİßéÉ \n\t\u0085\x1c'st1٣中a😀.!<|endoftext|>ﬁＡ"


def odd_texts(n=400, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 60))) for _ in range(n)] + ["", "  ", "x\n \ny", "x\n ", "a  b", "a   b \n", "a" * 3000, "ab" * 2000, "it's DON'T we'll", "<|endoftext|>", " a <|endoftext|> b"]


def test_chunked_encoding_is_the_librarys():
    from tokenizers import Tokenizer

    path = tokens.default_tokenizer()
    enc, own = tokens.encoder(path), Tokenizer.from_file(path)
    assert enc.fast is not None
    for t in odd_texts():
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == own.encode(t, add_special_tokens=False).ids, repr(t)


def test_merge_rounds_are_the_librarys():
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    own, lib = bpe.WordBpe(path), Tokenizer.from_file(path)
    texts = odd_texts(seed=2)
    for t, ids in zip(texts, own.encode(texts)):
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(t)
        assert own.decode(ids.tolist()) == lib.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_packing_places_every_id_once(capacity):
    r = random.Random(capacity)
    lengths = [r.choice([0, 1, 3, 10, 63, 64, 65, 500]) for _ in range(200)]
    doc, start, length, sequence, offset = packing.assign(lengths, capacity)
    pieces, rows = defaultdict(list), defaultdict(list)
    for d, s, n, q, o in zip(doc.tolist(), start.tolist(), length.tolist(), sequence.tolist(), offset.tolist()):
        pieces[d].append((s, n))
        rows[q].append((o, n))
    for d, n in enumerate(lengths):
        at = 0
        for s, k in sorted(pieces[d]):
            assert s == at and k > 0
            at += k
        assert at == n
    for row in rows.values():
        at = 0
        for o, n in sorted(row):
            assert o == at
            at += n
        assert at <= capacity
    assert sorted(rows) == list(range(len(rows)))
    assert len(rows) * capacity - sum(lengths) < capacity
    assert all(len(x) == 0 for x in packing.assign([], capacity))


def test_packing_balances_cost():
    lengths = [60] * 30 + [5] * 300
    doc, _, length, sequence, _ = packing.assign(lengths, 128, 1.0, 1.0)
    cost = np.bincount(sequence, weights=length + length.astype(float) ** 2)
    assert cost.max() < 2.2 * np.median(cost)


@pytest.mark.parametrize("vocabulary,bits", [(1, 1), (2, 1), (3, 2), (50257, 16), (49408, 16), (1 << 17, 17), (1 << 31, 31)])
def test_bit_widths_round_trip(vocabulary, bits):
    assert tokenfile.width(vocabulary) == bits
    ids = np.random.default_rng(0).integers(0, vocabulary, 1001).astype("<u4")
    data = tokenfile.pack_bits(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (tokenfile.unpack_bits(data, bits, 1001) == ids).all()
    with pytest.raises(ValueError):
        tokenfile.pack_bits(np.array([1 << bits], "<u4"), bits)


@pytest.mark.parametrize("bits", [5, 16, 17])
def test_token_file_random_access(tmp_path, bits):
    r = np.random.default_rng(bits)
    docs = [(k if k % 7 else None, r.integers(0, 1 << bits, int(n)).astype("<u4")) for k, n in enumerate(r.choice([0, 1, 5, 4095, 4096, 9000], 60))]
    fs, path = pafs.LocalFileSystem(), str(tmp_path / "f.bits")
    w = tokenfile.Writer(fs, path, bits)
    for k, ids in docs:
        w.add(k, ids.tobytes())
    w.close()
    read = tokenfile.Reader(fs, path)
    at = 0
    for (k, ids), (key, first, got) in zip(docs, read.documents(5000), strict=True):
        assert (key, first) == (k, at) and (got == ids).all()
        at += len(ids)
    every = np.concatenate([x for _, x in docs])
    for a, b in ((0, 0), (0, 1), (4095, 4097), (5000, 30000), (at - 1, at)):
        assert (read.slice(a, b) == every[a:b]).all()
    assert all((read.document(k) == docs[k][1]).all() for k in (0, 13, 59))
    (tmp_path / "bad").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        tokenfile.Reader(fs, str(tmp_path / "bad"))


def test_fingerprint_by_its_definition():
    import xxhash

    for t in ["", " \n", "one", "one two", "A b c", "The the THE the the", "é É x y z " * 9, "w\x0bx\x1cy z"]:
        words = t.encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert simhash.fingerprint(t) == want


@pytest.mark.parametrize("distance", range(1, 7))
def test_position_sets_cover(distance):
    sets = simhash.position_sets(distance)
    assert all(any(set(s).isdisjoint(changed) for s in sets) for changed in combinations(range(8), distance))


def groups_of(pairs, nodes):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    out = defaultdict(set)
    for x in nodes:
        out[root(x)].add(x)
    return {frozenset(v) for v in out.values()}


@pytest.mark.parametrize("distance,block", [(3, 1 << 15), (6, 1 << 15), (6, 64)])
def test_links_make_the_groups_of_all_pairs(distance, block):
    r = np.random.default_rng(distance)
    base = r.integers(0, 1 << 63, 60).astype(np.uint64)
    near = [base ^ (np.uint64(1) << r.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 60).astype(np.uint64)) for _ in range(4)]
    hot = base[0] ^ (np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64))
    fps = np.unique(np.concatenate([base, *near, hot]))
    want = [(int(fps[i]), int(fps[j])) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= distance]
    masks = [sum(0xFF << 8 * p for p in s) for s in simhash.position_sets(distance)]

    def go(rows, size):
        rows = sorted(rows)
        k, node = (np.array([x[i] for x in rows], np.int64) for i in (0, 1))
        value = np.array([x[2] % (1 << 64) for x in rows], np.uint64).view(np.int64)
        batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + 97]) for x in (k, node, value)], ["k", "node", "value"]) for i in range(0, len(k), 97)]
        return [x for b in simhash._links(distance, size)(iter(batches)) for x in zip(*[c.to_pylist() for c in b.columns])]

    numbered = lambda h, n: (h >> 2) & ~simhash._SETS | n
    met = go([(numbered(hash((n, int(x) & m)), n), i, int(x)) for i, x in enumerate(fps) for n, m in enumerate(masks)], block)
    large = [x for x in met if x[0]]
    blocks = defaultdict(int)
    for n, k, *_ in large:
        blocks[k] = max(blocks[k], n)
    found = [x for x in met if not x[0]] + go([(numbered(hash((k, min(n, o), max(n, o))), k & simhash._SETS), i, f) for n, k, i, f in large for o in range(1, blocks[k] + 1)], 2 * block)
    met = [(0, int(fps[a]), int(fps[b])) for _, a, b, _ in found]
    nodes = [int(x) for x in fps]
    assert groups_of([(a % (1 << 64), b % (1 << 64)) for _, a, b in met], nodes) == groups_of(want, nodes)


def test_repeats_by_brute_force():
    r = random.Random(3)
    for _ in range(150):
        letters = r.choice([b"ab", b"abcd", bytes(range(256))])
        word = lambda n: bytes(r.choice(letters) for _ in range(n))  # noqa: B023, E731
        base = word(60)
        contexts = [word(r.randint(0, 8)) + base[(a := r.randint(0, 40)) : a + r.randint(0, 40)] + word(r.randint(0, 8)) if r.random() < 0.6 else word(r.randint(0, 50)) for _ in range(r.randint(1, 12))]
        origin = np.array([r.choice([0, 1000 * k, 1000 * k]) for k in range(len(contexts))], np.uint64)
        count = np.array([r.choice([1, 1, 1, 2]) for _ in contexts], np.int64)
        span = r.choice([3, 8, 12])
        at = defaultdict(list)
        for k, c in enumerate(contexts):
            for o in range(len(c) - span + 1):
                at[c[o : o + span]].append((k, o))
        want, got = ([bytearray(len(c)) for c in contexts] for _ in range(2))
        for v in at.values():
            if len({int(origin[k]) + o for k, o in v}) > 1 or any(count[k] > 1 for k, _ in v):
                for k, o in v:
                    want[k][o : o + span] = b"\1" * span
        for k, a, b in suffix.repeated(contexts, origin, count, span):
            got[k][a:b] = b"\1" * (b - a)
        assert got == want


def test_anchors_of_equal_strings_are_equal_and_segments_agree(monkeypatch):
    r = random.Random(4)
    common = bytes(r.randrange(256) for _ in range(260))
    texts = [bytes(r.randrange(256) for _ in range(r.randint(0, 900))) + common + bytes(r.randrange(256) for _ in range(900)) for _ in range(5)]
    found = [defaultdict(set) for _ in texts]
    for of, at, h in suffix.anchors(texts):
        for k, p, x in zip(of.tolist(), at.tolist(), h.tolist()):
            found[k][x].add(p)
    shared = set.intersection(*map(set, found))
    for k, t in enumerate(texts):
        p = t.find(common)
        assert any(p <= q <= p + 260 - suffix.GRAM for x in shared for q in found[k][x])
    long = b"".join(texts) * 2
    whole = sorted((p, x) for _, at, h in suffix.anchors([long]) for p, x in zip(at.tolist(), h.tolist()))
    monkeypatch.setattr(suffix, "SEGMENT", 1000)
    assert sorted((p, x) for _, at, h in suffix.anchors([long]) for p, x in zip(at.tolist(), h.tolist())) == whole


def test_pages():
    field = html.trained()
    right = total = 0
    for seed in range(50_000, 50_150):  # seeds that training does not use
        page = html.blocks(html.training_page(seed))
        right += sum(b.label == x for b, x in zip(page, field.labels(page)))
        total += len(page)
    assert right / total > 0.97
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=/a>Menu</a></ul></nav><!-- c --><div class='ad'>Buy now.</div><article><h1>A  title</h1><p>One &amp; <b>two</b>.<br>Three.<script>x('</p>')</script><p>Four."
    assert field.text(page + "</article><footer>&copy; us</footer>") == "A title One & two. Three. Four."
    assert field.text(page) == "A title One & two. Three. Four."
    assert field.text("") == "" and field.text("<div") == "" and html.blocks("<p>" * 3000 + "x")[0].text == "x"


def test_viterbi_is_the_best_of_all_sequences():
    r = np.random.default_rng(5)
    for _ in range(50):
        n = int(r.integers(1, 8))
        field = html.Field({f"f{k}": float(r.normal()) for k in range(n)}, r.normal(size=(2, 2)))
        page = [html.Block("", [f"f{k}"]) for k in range(n)]

        def score(labels):
            return sum(field.weights[f"f{k}"] * x for k, x in enumerate(labels)) + sum(field.change[a, b] for a, b in zip(labels, labels[1:]))

        best = max(([x >> k & 1 for k in range(n)] for x in range(1 << n)), key=score)
        assert abs(score(best) - score(field.labels(page))) < 1e-9


def test_language_model():
    r = random.Random(6)
    said = {"aa": "the and of to in is".split(), "bb": "der die und nicht auch schön".split()}
    text = lambda lang, n: " ".join(r.choice(said[lang]) for _ in range(n))
    model = langid.train([(lang, langid.grams(text(lang, r.randint(1, 80))).astype(np.float32)) for lang in said for _ in range(60)])
    for lang in said:
        assert all(p[0] == lang and not p[2] for p in model.predict([text(lang, n) for n in (3, 20, 300)]))
    assert model.predict(["", "123 !!"]) == [(langid.UNKNOWN, 0.0, True)] * 2
    assert model.predict(["щщщщщ жжжжж ыыыыы ъъъъъ " * 20])[0][2]
    assert langid.train([]).predict(["abc"])[0][2]


def test_router_recall():
    r = np.random.default_rng(7)
    x = np.concatenate([r.normal(size=(400, 16)) + 4 * r.normal(size=16) for _ in range(6)])
    router = ann.fit(x, parts=8)
    scores = router.scores(x)
    home, probed = scores.argmax(axis=1), np.argsort(-scores, axis=1)[:, :3]
    near = ann.neighbour_graph(x, 10)
    assert np.mean([[home[j] in p for j in row] for row, p in zip(near, probed)]) >= 0.95
    part = ann.balanced_parts(near, 8)
    assert np.bincount(part, minlength=8).max() <= 1.1 * len(x) / 8 + 1


def test_ids_have_the_checksum_of_their_bytes():
    ids = np.array([1, 2, 50256], "<u4")
    assert zlib.crc32(ids.tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0\x50\xc4\0\0")


def test_stars_connect_what_links_do():
    from textloom.llm.graph import stars

    r = np.random.default_rng(3)
    x, y = r.integers(0, 400, 300), r.integers(0, 400, 300)
    root = {int(v): int(v) for v in np.r_[x, y]}
    for a, b in zip(x.tolist(), y.tolist()):
        keep, go = sorted((root[a], root[b]))
        root = {k: keep if v == go else v for k, v in root.items()}
    a, b = stars(x, y)
    assert dict(zip(b.tolist(), a.tolist())) == root
