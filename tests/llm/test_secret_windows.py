"""Entropy spans against a plain version that counts every window anew; long texts with very many matches."""

import math
import random
import re
import string
import time
from collections import Counter

import pytest

from barspan.llm import secrets

CANDIDATE = re.compile(secrets.CANDIDATE)


def entropy(text):
    return sum(-n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def dense(value):
    """First and last end of the windows that reach the bound of the value's class."""
    if re.search("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", value) or re.fullmatch("([A-Za-z]+|[0-9]+)([/_=+-]+([A-Za-z]+|[0-9]+))*[/_=+-]*", value):
        return None
    kind = next(c for c in secrets.CLASSES if re.search(c.pattern, value))
    n = min(kind.window, len(value))
    bound = kind.entropy * math.log2(n) / math.log2(kind.window)
    full = [i for i in range(len(value) - n + 1) if entropy(value[i : i + n]) >= bound - 1e-9]
    return (full[0], full[-1] + n) if full else None


def plain_spans(text):
    base, found = [], []
    for rank, (_, pattern, group, least) in enumerate(secrets.KINDS, 1):
        base += [(m.start(), rank, m.end()) for m in re.finditer(pattern.replace(r"\x20", " "), text) if len(m.group(group)) >= least]
    allow = secrets.ALLOW_PARTS
    for run in CANDIDATE.finditer(text):
        at = 0
        parts = [(m.start(), m.end()) for m in re.finditer(allow, run.group())] + [(len(run.group()), None)]
        for begin, end in parts:
            stretch = run.group()[at:begin]
            pieces = {(0, stretch)} if len(stretch) >= 20 else set()
            for p in secrets.PIECES if pieces else ():
                pieces |= {(m.start(), m.group()) for m in re.finditer(p, stretch)}
            for offset, piece in pieces:
                span = dense(piece) if re.search("[A-Za-z]", piece) and re.search("[0-9]", piece) else None
                if span:
                    found.append((run.start() + at + offset + span[0], run.start() + at + offset + span[1]))
            at = end
    merged = []
    for start, end in sorted(found):
        if merged and merged[-1][1] > start:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    told = [(s, 4, e) for s, e in merged if not any(a <= s and e <= b for a, _, b in base)]
    names = ["assign", "access", "hex", "entropy"]
    return ",".join(f"{names[k - 1]}:{s}:{e}" for s, k, e in sorted(base + told))


def random_text(rng):
    alphabets = [string.hexdigits, "abcdef0123456789", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/_=-", "ab1", "ABC123-", string.digits + "-"]
    glue = [" ", "\n", "=", "password=", "token: ", "é ", "/", "-", "example", "sample=", "AKIA", ", "]
    out = []
    for _ in range(rng.randint(1, 14)):
        out.append("".join(rng.choice(rng.choice(alphabets)) if rng.random() < 0.02 else c for c in rng.choices(rng.choice(alphabets), k=rng.randint(1, 60))))
        out.append(rng.choice(glue))
    return "".join(out)


def spans(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.spans for r in secrets.find_secrets(rows).orderBy("doc_id").collect()]


def test_every_window(spark):
    rng = random.Random(6)
    texts = [random_text(rng) for _ in range(400)] + ["", " ", "123e4567-e89b-12d3-a456-426614174000", "one-two-three-four-five-2024-six-seven"]
    assert spans(spark, texts) == [plain_spans(t) for t in texts]


@pytest.mark.parametrize("blocks", [1, 2, 128])
def test_running(spark, monkeypatch, blocks):
    """Sums and maxima of what came before, over many blocks and none."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(secrets, "BLOCK", blocks)
    rng = random.Random(blocks)
    lists = [[rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 2, 5, 127, 128, 129, 300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<int>")
    df = df.select("i", secrets._running(F.col("x"), lambda a, b: a + b).alias("sums"), secrets._running(F.col("x"), lambda a, b: F.greatest(a, b)).alias("tops"))
    for r in df.orderBy("i").collect():
        x = lists[r.i]
        assert r.sums == [sum(x[:k]) for k in range(len(x))] and r.tops == [max([0, *x[:k]]) for k in range(len(x))]


def test_long_texts(spark):
    """No stack, no square of the matches: a megabyte of signs between words, of hex words, and long runs."""
    rng = random.Random(1)
    runs = "\n".join("".join(rng.choices(string.ascii_letters + string.digits + "+/", k=64)) for _ in range(2000))
    hex_words = "0123456789abcdef " * (1 << 16)
    begin = time.time()
    got = spans(spark, ["ab-12-" * (1 << 17), hex_words, runs, "x7" * 200_000])
    assert time.time() - begin < 120
    assert got[0] == "" and got[3] == ""
    assert got[1].startswith("hex:0:16,hex:17:33,") and got[1].count(",") == (1 << 16) - 1
    assert got[2] == plain_spans(runs)
