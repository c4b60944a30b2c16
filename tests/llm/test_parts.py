"""Pieces below the operators: coding, sketches, suffix sort, salvage, masks, components."""

import io
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barspan.llm import iblt, near_dedup, repeated_bytes, spaced_seeds, suffix_sort, warc, word_packing
from barspan.llm import texts as tx
from barspan.llm.components import min_labels


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300) | st.just(0), max_size=400))
@settings(deadline=None, max_examples=60)
def test_packing_round_trip(values):
    values = np.array(values, np.uint64)
    assert (word_packing.unpack(word_packing.pack(values), len(values)) == values).all()


def test_small_ids_share_words():
    assert len(word_packing.pack(np.zeros(600, np.uint64))) == 10
    assert len(word_packing.pack(np.full(600, 2**15 - 1, np.uint64))) == 150


def test_token_file_blocks_and_damage():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_000, n) for n in (0, 5, 100_000, 1, 70_000, 0)]
    out = word_packing.TokenFileWriter()
    for i, ids in enumerate(docs):
        out.add(None if i == 1 else i, ids)
    content = out.content()
    file = word_packing.TokenFile(content)
    assert all((file.ids(i) == ids).all() for i, ids in enumerate(docs)) and file.doc_ids[1] == word_packing.NO_ID
    with pytest.raises(ValueError):
        word_packing.TokenFile(content[:100] + b"?" + content[101:])


@given(st.data())
@settings(deadline=None, max_examples=60)
def test_suffix_sort(data):
    text = np.array(data.draw(st.lists(st.integers(97, 99), min_size=12, max_size=120)), np.uint8)
    length = data.draw(st.integers(1, 8))
    at = np.array(data.draw(st.lists(st.integers(0, len(text) - length), min_size=1, max_size=60, unique=True)))
    classes = np.sort(data.draw(st.lists(st.integers(0, 2), min_size=len(at), max_size=len(at))))
    classes = np.unique(classes, return_inverse=True)[1]
    seen, want = set(), []
    for a, c in zip(at, classes):
        want.append((c, text[a : a + length].tobytes()) in seen)
        seen.add((c, text[a : a + length].tobytes()))
    assert suffix_sort.repeats(text, at, classes, length).tolist() == want
    order = suffix_sort.sort_suffixes(text, tx.prefix_hashes(text), at, np.zeros(len(at), int), length)
    keys = [text[a : a + length].tobytes() for a in at]
    assert order.tolist() == sorted(range(len(at)), key=lambda i: (keys[i], i))


def test_suffix_sort_survives_collisions(monkeypatch):
    """With a hash that calls everything equal the bytes still decide."""
    monkeypatch.setattr(tx, "prefix_hashes", lambda data, family=0: np.zeros(len(data) + 1, np.uint64))
    text = np.frombuffer(b"abcabdabcabe", np.uint8)
    at = np.array([0, 3, 6, 9])
    assert suffix_sort.repeats(text, at, np.zeros(4, int), 3).tolist() == [False, False, True, False]


def test_suffix_sort_compares_a_large_class_a_few_times(monkeypatch):
    """Twenty thousand suffixes of one class, half of them alike: no more than eight comparisons each."""
    compared, extension = [], suffix_sort._extension
    monkeypatch.setattr(suffix_sort, "_extension", lambda prefix, a, *rest: compared.append(len(a)) or extension(prefix, a, *rest))
    text = np.random.default_rng(3).integers(97, 101, 10_100).astype(np.uint8)
    text = np.concatenate([text, text])
    at = np.concatenate([np.arange(10_000), np.arange(10_100, 20_100)])
    found = suffix_sort.repeats(text, at, np.zeros(len(at), int), 100)
    assert found.tolist() == [False] * 10_000 + [True] * 10_000 and sum(compared) < 8 * len(at)


@pytest.mark.parametrize("same", [True, False])
def test_windows_that_repeat_within_their_block(same, monkeypatch):
    """Of runs of one character or of a few only the first windows are left, unless the bytes say that the hashes collide."""
    texts = ["x" * 5000 + " and then " + "-=" * 3000, "no run here, but words enough for a window or two " * 2, "z" * 99, "y" * 300]
    found = tx.Texts(pa.array(texts, pa.large_string()))
    if not same:
        monkeypatch.setattr(suffix_sort, "same_bytes", lambda data, a, b, length: np.zeros(len(a), bool))
    blocks = repeated_bytes._blocks_of(found, 100, 40)
    *_, text, first, count = repeated_bytes._own_repeats(found, blocks, 100)
    known = count >= repeated_bytes._KNOWN
    assert known.any() == same and (count < 0).any() != same
    windows = sorted((t, f + i, k) for t, f, n, k in zip(text.tolist(), first.tolist(), count.tolist(), known.tolist()) for i in range(abs(n) % repeated_bytes._KNOWN))
    assert [w[:2] for w in windows] == [(t, p) for t, x in enumerate(texts) for p in range(len(x) - 99)]
    if same:
        for t, p, k in windows:
            assert not k or texts[t].find(texts[t][p : p + 100]) < p
        assert sum(not k for t, _, k in windows if t != 1) < 400


@given(st.lists(st.text(st.sampled_from("ab \n"), max_size=40), min_size=1, max_size=5), st.integers(3, 9))
@settings(deadline=None, max_examples=60)
def test_blocks_cover_every_window_once(texts, length):
    gram = max(1, length // 2)
    found = tx.Texts(pa.array(texts, pa.large_string()))
    _, content, text, first, count = repeated_bytes._blocks_of(found, length, gram)
    windows = sorted((t, f + i) for t, f, n in zip(text.tolist(), first.tolist(), np.abs(count).tolist()) for i in range(n))
    assert windows == [(t, p) for t, x in enumerate(texts) for p in range(len(x.encode()) - length + 1)]
    for t, f, n in zip(text, first, count):
        own = [texts[t][f + i : f + i + length] for i in range(abs(n))]
        assert n < 0 or len(set(own)) == len(own)  # blocks that repeat within themselves are marked


@given(st.lists(st.text(st.sampled_from("abc \n"), max_size=80), min_size=2, max_size=6))
@settings(deadline=None, max_examples=40)
def test_sketch_differences(texts):
    found = iblt.Digests(tx.Texts(pa.array(texts, pa.large_string())))
    of = lambda i: set(found.values[found.offsets[i] : found.offsets[i + 1]].tolist())
    a, b = np.arange(len(texts) - 1), np.arange(1, len(texts))
    for i, (only_a, only_b) in enumerate(iblt.differences(found, a, found, b)):
        assert set(only_a.tolist()) == of(i) - of(i + 1) and set(only_b.tolist()) == of(i + 1) - of(i)


def test_large_differences_need_larger_sketches():
    left = iblt.Digests(tx.Texts(pa.array([" ".join(f"w{i}" for i in range(3000)), "same"], pa.large_string())))
    right = iblt.Digests(tx.Texts(pa.array([" ".join(f"v{i}" for i in range(3000)), "same"], pa.large_string())))
    near = iblt.likeness(left, np.array([0, 1]), right, np.array([0, 1]))
    assert near.tolist() == [0.0, 1.0]


def test_masks_hit_every_window_with_three_replaced_words():
    for gone in itertools.combinations(range(spaced_seeds.WINDOW), spaced_seeds.WINDOW - spaced_seeds.AGREE):
        assert any(
            all(at + j not in gone for j, used in enumerate(mask) if used == "1")
            for mask in spaced_seeds.MASKS
            for at in range(spaced_seeds.WINDOW - len(mask) + 1)
        )
    assert all(len(m) == spaced_seeds.SPAN for m in spaced_seeds.MASKS)


def test_masks_hit_short_items_with_every_permitted_replacement():
    for n in range(spaced_seeds.SPAN, spaced_seeds.WINDOW + 1):
        allowed = n - -(-n * spaced_seeds.AGREE // spaced_seeds.WINDOW)
        masks = spaced_seeds._masks([n])
        for gone in itertools.chain(*(itertools.combinations(range(n), k) for k in range(allowed + 1))):
            assert any(
                all(at + j not in gone for j, used in enumerate(mask) if used == "1")
                for mask in masks
                for at in range(n - len(mask) + 1)
            ), (n, gone)


def _archive(compressed):
    parts = [warc.record_bytes(i, f"http://x/{i}", f"payload {i} ".encode() * 50, None) for i in range(6)]
    if compressed:
        parts = [(d := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(p) + d.flush() for p in parts]
    return parts


def _salvaged(data):
    return list(warc.SalvageReader(pa.PythonFile(io.BytesIO(data), mode="r")))


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "header", "tail"])
def test_salvage(compressed, damage):
    parts = _archive(compressed)
    ends = np.cumsum([len(p) for p in parts])
    middle = len(parts[2]) // 2
    if damage == "flip":
        parts[2] = parts[2][:middle] + bytes([parts[2][middle] ^ 0xFF]) + parts[2][middle + 1 :]
    elif damage == "cut":
        parts[2] = parts[2][:middle]
    elif damage == "junk":
        parts[2] = b"junk \x1f\x8b\x08 WARC/1.1 junk"
    elif damage == "header":
        parts[2] = b"\0\0\0" + parts[2][3:]
    else:
        parts[5] = parts[5][:-9]
    lost = 5 if damage == "tail" else 2
    found = _salvaged(b"".join(parts))
    records = [x for x in found if isinstance(x, warc.Record)]
    gaps = [x for x in found if isinstance(x, warc.Gap)]
    assert [r.fields["page-id"] for r in records] == [str(i) for i in range(6) if i != lost]
    start = 0 if lost == 0 else int(ends[lost - 1])
    assert [(g.offset, g.end) for g in gaps] == [(start, start + len(parts[lost]))] and gaps[0].reason


def test_salvage_of_intact_empty_and_foreign_files():
    assert len(_salvaged(b"".join(_archive(True)))) == 6
    assert _salvaged(b"") == []
    assert [(g.offset, g.end) for g in _salvaged(b"not an archive")] == [(0, 14)]


def test_components(spark, tmp_path):
    links = [(1, 2), (2, 3), (3, 9), (10, 4), (4, 7), (20, 21), (5, 5)] + [(100 + i, 101 + i) for i in range(40)]
    nodes = spark.createDataFrame([(i,) for i in {x for p in links for x in p} | {77}], "doc_id long")
    got = {r.doc_id: r.label for r in min_labels(nodes, spark.createDataFrame(links, "a long, b long"), str(tmp_path)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 10: 4, 4: 4, 7: 4, 20: 20, 21: 20, 5: 5, 77: 77} | {100 + i: 100 for i in range(41)}


def test_least_matches_leave_almost_no_link_out():
    for percent in (80, 85):
        n, p = near_dedup.least_matches(percent), percent / 100
        draws = np.random.default_rng(0).binomial(near_dedup.COORDINATES, p, 2_000_000)
        assert (draws < n).sum() == 0 and n >= near_dedup.COORDINATES * 0.45
