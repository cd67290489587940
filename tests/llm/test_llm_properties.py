"""Properties of the kernels of the training-data operators, without a session."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import decontaminate, html, lines, packing, simhash, substrings


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 20)), max_size=12))
def test_runs_cover_what_the_intervals_cover(spans):
    lo, hi = np.array([a for a, _ in spans], int), np.array([a + n for a, n in spans], int)
    got = np.zeros(80, bool)
    for a, z in substrings.covered(80, lo, hi):
        got[a:z] = True
    want = np.zeros(80, bool)
    for a, n in spans:
        want[a : a + n] = True
    assert (got == want).all()
    runs = substrings.covered(80, lo, hi)
    assert all(p[1] < q[0] for p, q in zip(runs, runs[1:]))


@settings(max_examples=60)
@given(st.lists(st.lists(st.integers(0, 2), min_size=9, max_size=9), min_size=1, max_size=40), st.integers(1, 3))
def test_suffixes_are_sorted(rows, groups):
    text = np.array(rows, np.uint8)
    group = np.sort(np.arange(len(text)) % groups)
    order = substrings.deep_shallow(group, text)
    keys = [(int(group[i]), text[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(text)))


@given(st.lists(st.binary(min_size=6, max_size=6), min_size=1, max_size=30))
def test_tries_sort(strings):
    assert [strings[i] for i in substrings.trie_sorted(list(range(len(strings))), strings)] == sorted(strings)


@given(st.integers(1, 9000), st.sampled_from([7, 64, 2048]))
def test_pieces_are_whole_and_full(n, size):
    got = packing.cuts(n, size)
    assert sum(k for _, k in got) == n and all(k == size for _, k in got[1:]) and 0 < got[0][1] <= size
    assert [s for s, _ in got] == np.concatenate([[0], np.cumsum([k for _, k in got])[:-1]]).tolist()


@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_bins_hold_their_pieces(lengths):
    n = np.sort(np.array(lengths))[::-1]
    bins = packing.best_fit(n, 64)
    assert np.bincount(bins, weights=n).max() <= 64
    assert packing.lower_bound(n, 64) <= bins.max() + 1


@given(st.integers(0, 2**23 - 1), st.integers(0, 22))
def test_neighbouring_words_share_a_codeword(word, bit):
    errors = simhash.decoder()
    flips = np.concatenate([[0], 1 << np.arange(23)])
    near = lambda w: set(simhash.codewords(np.int64(w) ^ flips, errors).tolist())
    assert near(word) & near(word ^ 1 << bit)


@given(st.text(alphabet="ab \n", max_size=200))
def test_chunks_tile_the_lines(text):
    hashes = np.array([lines.line_hash(x) for x in text.encode().split(b"\n")], np.int64)
    ends = lines.boundaries(hashes).tolist()
    assert ends == sorted(set(ends)) and ends[0] > 0 and ends[-1] == len(hashes)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=8))
def test_merged_spans_do_not_touch(spans):
    out = decontaminate.merged([(a, a + n) for a, n in spans])
    assert all(p[1] < q[0] for p, q in zip(out, out[1:]))
    assert {k for a, z in out for k in range(a, z)} == {k for a, n in spans for k in range(a, a + n)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<script>", "</script>", "<br>", "text ", "&amp;", "&#x41;", "<", ">", '"', "<!--", "-->", "<a href='x>y'>", "</a>", "<td>", "<table>", "<h1>", "<title>", " "]), max_size=40))
def test_any_markup_is_parsed(parts):
    out = html.extract("".join(parts), html.trained())
    assert all(line and line == line.strip() for line in out.split("\n")) or out == ""


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 99)), max_size=30), st.lists(st.integers(0, 6), max_size=12))
def test_keys_are_never_parted(rows, sizes):
    import pyarrow as pa

    rows, at, batches = sorted(rows), 0, []
    for n in [*sizes, 1000]:
        part = rows[at : at + n]
        at += n
        batches.append(pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.int64()), pa.array([v for _, v in part], pa.int64())], ["key", "v"]))
    groups = list(simhash.whole_keys(iter(batches), ("key", "v")))
    assert [tuple(x) for key, v in groups for x in zip(key.tolist(), v.tolist())] == rows
    seen = [set(key.tolist()) for key, _ in groups]
    assert all(not a & b for i, a in enumerate(seen) for b in seen[:i])
