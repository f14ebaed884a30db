"""Hostile and long rows: four times the input takes about four times as long, not sixteen."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import html_text, pieces, pii, secrets


def grows_slowly(run, sizes, limit=8.0, floor=0.3, times=2):
    """Time for each size; from one to the next (four times as large) under `limit` times, where it isn't too short to tell."""
    took = []
    for n in sizes:
        best = min(timed(run, n) for _ in range(times))
        took.append(best)
    for a, b in zip(took, took[1:], strict=False):
        assert b < limit * max(a, floor), took


def timed(run, n):
    began = time.perf_counter()
    run(n)
    return time.perf_counter() - began


PAGES = {
    "open quotes": '<a "', "open tags": "<a ", "stray ends": "<div></p>", "mixed quotes": "<a '\">x", "open comments": "<!-- x", "raw": "<textarea>", "tags in tags": "<p <b", "deep": "<div>x", "less": "< ",
}


@pytest.mark.parametrize("name", PAGES)
def test_broken_pages(name):
    grows_slowly(lambda n: html_text.main_text(PAGES[name] * n), (8_000, 32_000, 128_000))


def test_open_elements_with_as_many_stray_ends():
    grows_slowly(lambda n: html_text.main_text("<div>" * n + "</p>" * n + "</section>" * n), (4_000, 16_000, 64_000))


def test_broken_tags_read_on():
    read = lambda x: html_text.main_text(f"<article><p>{'one of the words and the other ' * 9}</p>{x}</article>").removeprefix("one of the words and the other " * 9 + "").strip()
    tail = "this is the end of it and of all the words that are in the text " * 4
    assert read(f'<p class="x" <p>{tail}</p>').endswith(tail.strip()) and read(f"<p><a title='it\"s'>{tail}</a></p>").endswith(tail.strip())
    assert 'class="x"' not in read(f'<p class="x" <p>{tail}</p>') and "title" not in read(f'<p title="never closed <b>{tail}</b></p>')


def test_personal_data_in_one_long_text(spark):
    def run(n):
        text = " ".join(f"10.0.{i % 250}.7 x" for i in range(n))
        assert spark.createDataFrame([(text,)], "text string").select(F.size(pii.pii_spans(F.col("text"))).alias("n")).first().n == n

    grows_slowly(run, (5_000, 20_000, 80_000), floor=4.0, times=1)


def test_context_over_block_borders(spark):
    """A context word on either side of a border of blocks is found wherever the span stands."""
    for shift in range(pii.BLOCK - 70, pii.BLOCK + 20, 7):
        text = "x " * (shift // 2) + "bank account 378282246310005 and on " + "y" * 2000
        (spans,) = spark.createDataFrame([(text,)], "text string").select(pii.joined(pii.pii_spans(F.col("text")))).first()
        at = text.index("3782")
        assert spans == f"account:{at}:{at + 15}"


def test_many_tokens_in_one_long_text(spark):
    import random

    rng = random.Random(1)
    tokens = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40)) for _ in range(500)]

    def run(n):
        text = " ".join(tokens[i % 500] for i in range(n))
        none = F.array().cast(secrets.SPAN)
        found = spark.createDataFrame([(text,)], "text string").select(secrets.candidate_spans(F.col("text"), none).alias("c"))
        assert found.select(F.size("c").alias("n")).first().n == n

    grows_slowly(run, (1_000, 4_000, 16_000), floor=4.0, times=1)


@pytest.mark.parametrize("unit", ["a", "-", "ab", "xyz="])
def test_runs_as_one_word(unit):
    model = pieces._transducer(pieces.read_model())
    grows_slowly(lambda n: model.encode((unit * n)[:n]), (8_000, 32_000, 128_000), floor=2.0, times=1)
    for n in (2_000, 9_001):
        word = (unit * n)[:n]
        last, span, _ = model._relaxed([word])  # the whole word, place by place
        at, found = n, []
        while at:
            found.append(int(last[at]))
            at -= int(span[at])
        assert np.frombuffer(model._long_path(word), np.int32).tolist() == found[::-1]
