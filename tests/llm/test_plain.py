"""Parts of the operators that need no Spark, against plain versions."""

from __future__ import annotations

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablegrade.llm import decontamination, html_text, language, lsh_forest, packing, quality, toxicity
from tablegrade.llm.common import hashed_words

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_are_hashed_as_the_pattern_finds_them(text):
    words = re.findall(r"\w+", text.lower())
    hashes = hashed_words(text).tolist()
    assert len(hashes) == len(words)
    assert len(set(hashes)) == len(set(words)) == len(set(zip(words, hashes, strict=True)))


@given(st.lists(st.integers(-5, 5), max_size=40))
@settings(max_examples=300, deadline=None)
def test_segments_are_maximal(scores):
    def plain(low: int, high: int) -> list[tuple[int, int, float]]:
        """The best part (shortest, then first, of those), and the same left and right of it."""
        best = max(((sum(scores[a:b]), a - b, -a) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a, b = -best[2], -best[2] - best[1]
        return [*plain(low, a), (a, b, float(best[0])), *plain(b, high)]

    found = toxicity.segments(np.array(scores, float))
    assert sum(s for _, _, s in found) == sum(s for _, _, s in plain(0, len(scores)))
    assert max((s for _, _, s in found), default=0) == max((s for _, _, s in plain(0, len(scores))), default=0)
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


def test_words_score_at_every_place():
    toxic, clean = np.zeros(toxicity.PLACES, np.float32), np.full(toxicity.PLACES, 900, np.float32)
    for word in ("idiot", "scum"):
        places = toxicity.chain(word)
        toxic[places], clean[places] = 90, 10
    model = toxicity.Toxicity(toxic, clean, 0.1, scale=3.5, expected=0.005)
    calm = "the wood is green again " * 20
    dense = "idiot scum idiot scum idiot"
    found = [(a, b) for a, b, _ in model.passages(f"{dense} {calm} {dense}")]
    assert found == [(0, 5), (105, 110)]
    assert model.passages("idiot " * 39)[0][:2] == (0, 39)
    assert model.score("idiot " * 39) > model.score("idiot " + "the " * 38)


@given(st.text(max_size=200) | st.sampled_from(["<|endoftext|> it's  \n\n 12 é\u00a0ß", "a" * 5000, "", "日本語 テキスト"]))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_tokenizers_library(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    plain.encode_special_tokens = True
    assert packing.encoder(packing.default_tokenizer())(text) == plain.encode(text, add_special_tokens=False).ids


@given(st.integers(1, 5000), st.sampled_from([0.0, 1 / 64, 1 / 16, 1.0]))
def test_cuts(length, slack):
    found = packing.cuts(length, 1024, slack)
    assert sum(found) == length
    assert all(1024 - 1024 // n * n <= slack * 1024 for n in found)


@given(st.lists(st.integers(1, 3000), max_size=60))
@settings(max_examples=100, deadline=None)
def test_sequences(lengths):
    worker = packing.Worker(1024, 1 / 16, 0)
    for doc, n in enumerate(lengths):
        worker.add(doc, np.arange(n, dtype="<u4"))
    worker.finish()
    rows = worker.drain()
    parts, sequences = {}, {}
    for doc, start, length, _, total, sequence, offset in rows:
        assert total == lengths[doc]
        parts.setdefault(doc, []).append((start, length))
        sequences.setdefault(sequence, []).append((offset, length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(parts[doc]):
            assert start == at
            at += length
        assert at == n
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 or 960 <= at <= 1024


def test_language_edges():
    profiles = language.Profiles(["en"], np.array([101], np.uint64), np.zeros((1, 1), int), 400)
    assert profiles.nearest(None) == profiles.nearest("12 … !") == ("und", 0.0)
    assert profiles.nearest("e")[0] == "en" and 0 <= profiles.nearest("x" * 100_000)[1] <= 1


def test_quality_of_edges():
    assert quality.measure(None) == quality.measure("") == quality.Measures()
    m = quality.measure("a b c a b c\n\na b c a b c")
    assert (m.n_words, m.n_dup_lines, m.n_repeat_words) == (12, 1, 12)


def test_label_model_tells_rules_apart():
    rng = np.random.default_rng(1)
    good = rng.random(4000) < 0.8
    votes = np.where(rng.random((4000, len(quality.RULES))) < np.where(good[:, None], 0.01, 0.45), -1, 1)
    codes = ((votes + 1) * 3 ** np.arange(len(quality.RULES) - 1, -1, -1)).sum(axis=1)
    values, counts = np.unique(codes, return_counts=True)
    model = quality.fit(values, counts.astype(float))
    assert abs(model.good - 0.8) < 0.03
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.97


def test_overlaps_of_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.int64)) for _ in range(12)]
    plain = [[len(set(a) & set(b)) for b in sets] for a in sets]
    found = lsh_forest.overlaps(sets)
    assert all(found[i, j] == plain[i][j] for i in range(12) for j in range(12) if i != j)


def test_similarity_of_bags():
    assert decontamination.similarity([1, 2, 3], [1, 2, 3], [1.0, 2.0, 3.0], 5.0) == 1
    assert decontamination.similarity([1, 2, 9], [1, 2, 3], [1.0, 2.0, 3.0], 5.0) == pytest.approx(3 / 11)
    assert decontamination.similarity([], [], [], 1.0) == 0


def test_every_near_block_is_entered():
    flips = set(decontamination.near_values(16, 3).tolist())
    assert flips == {n for n in range(1 << 16) if n.bit_count() <= 3}
    assert sum(decontamination.WIDTHS) == decontamination.BITS
    rng = random.Random(4)
    for _ in range(2000):  # whichever bits differ, some block differs in few
        differ = rng.sample(range(decontamination.BITS), decontamination.RADIUS)
        blocks = [sum(shift <= bit < shift + width for bit in differ) for shift, width in zip(decontamination.SHIFTS, decontamination.WIDTHS, strict=True)]
        assert sum(blocks) == decontamination.RADIUS and min(blocks) <= decontamination.FLIPS


def test_fingerprints_of_edited_items_lie_within_the_radius():
    """4,000 items of 45 or 46 shingles with one word edited, of similarity 0.80."""
    rng, lost = np.random.default_rng(3), 0
    for i in range(4000):
        words = rng.integers(0, 1 << 63, 49 + i % 2).astype(np.uint64)
        near = words.copy()
        near[24] += np.uint64(1)
        a, b = decontamination.bag(words), decontamination.bag(near)
        assert decontamination.similarity(a.tolist(), b.tolist(), [1.0] * len(a), 1.0) >= 0.8
        prints = decontamination.fingerprints(np.stack([decontamination.bits_of(x).sum(axis=0) for x in (a, b)]))
        lost += (int(prints[0] ^ prints[1]) & (1 << 64) - 1).bit_count() > decontamination.RADIUS
    assert lost <= 10


def test_page_blocks():
    page = "<p>a &amp; b<br>c  d</p><script>x='</p>'</script><nav><a href=#>m</a></nav><!-- <p>no --> <div class='ad'>buy</div><p>e<b>f</b"
    blocks = html_text.blocks_of(page)
    assert [b.text for b in blocks] == ["a & b c d", "m", "buy", "ef"]
    assert [b.other for b in blocks] == [False, True, True, False] and blocks[1].links == 1
    assert html_text.blocks_of(None) == html_text.blocks_of("") == []
    assert [b.text for b in html_text.blocks_of("1 < 2 <")] == ["1 < 2 <"]


def test_repeated_words():
    text = "x y z " * 50
    words = text.split()
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    assert quality.measure(text).n_repeat_words == 150 and max(windows.values()) > 1
