from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperlake.llm import secrets
from tests.llm.fixtures import DOCUMENT, documents, with_clashes

KINDS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
]
TEXTS = [
    None,
    "",
    "no secrets here, only words and 2024-01-31 and 550e8400-e29b-41d4-a716-446655440000",
    "secret=\"token:abcdefghij\" é😀 TOKEN = 'abcdefgh' tokens=short1",
    "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + "-AKIAAKIA" + "C" * 9,
    "0123456789abcdef" * 4 + " " + "a" * 31 + " " + "f" * 32 + "F",
    "😀" * 50 + "k8Jd0sLqPz3XvN7tYw2RbF5hGc9M end",
    "x " * 3000 + "password=abcdefgh1 " * 300,
    "api_key : " + "deadbeef" * 8 + "\n" + "a" * 100_000,
    "thisisaverylonglowercasewordwithoutdigits and/also/a/path/of/many/words-and-more_words",
    "0000000000000000000000000000000a aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1",
    "passwd='p4ssw0rd!' apikey=\"ABCDEFG\"",
]


def brute_base(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(found)


def brute_high(text, kind):
    """Every window's entropy from scratch."""
    width = min(kind.window, len(text))
    needed = kind.share * min(math.log2(width), math.log2(len(kind.alphabet)))
    high = []
    for at in range(len(text) - width + 1):
        counts = Counter(text[at : at + width]).values()
        if -sum(c / width * math.log2(c / width) for c in counts) >= needed + 1e-9:
            high.append(at)
    return (high[0], high[-1] + width) if high else None


def brute_all(text):
    base = brute_base(text)
    more = []
    for kind in secrets.ENTROPY_KINDS:
        inside = "[" + re.escape(kind.alphabet) + "]"
        for m in re.finditer(f"{inside}{{{kind.least},}}", text or ""):
            if not any(re.search(a, m[0], re.A) for a in secrets.ALLOWED) and (part := brute_high(m[0], kind)):
                span = (m.start() + part[0], secrets.KINDS.index(kind.name), kind.name, m.start() + part[1])
                if not any(b[0] <= span[0] and span[3] <= b[3] for b in base):
                    more.append(span)
    return sorted(base + more)


def test_spans_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in secrets.find_secrets(with_clashes(df)).collect():
        got = [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"]]
        assert got == brute_all(TEXTS[r["doc_id"]]), r["doc_id"]


def test_high_entropy_is_found_and_words_are_not(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.find_secrets(df).collect()}
    assert "entropy64" in kinds[6] and not kinds[2] and not kinds[9] and kinds[10] == ["hex"]


@pytest.mark.parametrize("size", [1, 63, 64, 65, 300])
def test_running_sums(spark, size):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(size)).alias("v"))
    (got,) = df.select(secrets._running(F.col("v"), lambda a, b: a + b).alias("s")).first()
    assert got == [sum(range(1, i)) for i in range(1, size + 1)]


def test_redaction_replaces_merged_spans(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    df = with_clashes(spark.createDataFrame(rows, DOCUMENT))
    out = secrets.redact(df)
    assert out.columns == df.columns
    for r in out.collect():
        text, wanted, at, inside = TEXTS[r["doc_id"]], "", 0, 0
        for start, _, _, end in brute_all(text):
            if start >= inside:
                wanted += text[at:start] + secrets.REDACTED
            at = inside = max(inside, end)
        wanted = text if text is None else wanted + text[at:]
        assert r["text"] == wanted and r["n_chars"] == (None if wanted is None else len(wanted))
        assert r["spans"] == -7


def test_awkward_and_empty_tables(spark):
    df = documents(spark)
    assert secrets.find_secrets(df).count() == secrets.redact(df).count() == df.count()
    assert secrets.find_secrets(spark.createDataFrame([], DOCUMENT)).collect() == []


def test_no_python_and_no_shuffle(spark, folder):
    documents(spark).write.parquet(f"{folder}/d")
    plan = secrets.find_secrets(spark.read.parquet(f"{folder}/d"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_upper_case_hexadecimal_keys_are_found_and_redacted(spark):
    digits = [hashlib.sha256(str(i).encode()).hexdigest().upper() for i in range(8)]
    keys = [d[:size] for d in digits for size in (24, 28, 32, 40, 64)]
    texts = [f"the key {k} of it" for k in keys] + ["F" * 40, "2024" * 7, "550E8400-E29B-41D4-A716-446655440000", "DEADBEEF" * 2]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCUMENT)
    for r in secrets.find_secrets(df).collect():
        assert [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"]] == brute_all(texts[r["doc_id"]])
    kept = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    for i, text in enumerate(texts):
        # The span covers all windows of high entropy; a low one at an end may leave characters of the key.
        left = kept[i].removeprefix("the key ").removesuffix(" of it").replace(secrets.REDACTED, "")
        assert len(left) <= len(keys[i]) - 20 and secrets.REDACTED in kept[i] if i < len(keys) else kept[i] == text


def test_long_strings_take_linear_time_and_no_stack(spark):
    """A megabyte of base64, strings of ten thousand joined parts, and what is hidden behind them."""
    rng = random.Random(11)
    alphabet = string.ascii_letters + string.digits + "+/"
    encoded = "".join(rng.choice(alphabet) for _ in range(1_000_000))
    texts = [
        f"data:{encoded} password=abcdefgh1",
        "a" + "-a" * 10_000 + " password=abcdefgh1",
        "1" + "-1" * 10_000,
        "word" + "+/_=-" * 5_000 + "7",
    ]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCUMENT)
    found = {r["doc_id"]: [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"]] for r in secrets.find_secrets(df).collect()}
    for i, text in enumerate(texts):
        assert [s for s in found[i] if s[2] in secrets.BASE_KINDS] == brute_base(text)
    assert found[0][0] == (5, secrets.KINDS.index("entropy64"), "entropy64", 1_000_005)
    assert found[2] == []
    kept = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert kept[0] == f"data:{secrets.REDACTED} {secrets.REDACTED}" and kept[2] == texts[2]
    assert kept[1] == texts[1].removesuffix("password=abcdefgh1") + secrets.REDACTED


@pytest.mark.parametrize("pattern,parts", [(0, "aZ"), (1, "07")])
def test_the_allow_list_is_joined_words_or_numbers(pattern, parts):
    """As patterns with repeated groups said it, for all short strings."""
    old = [r"^[A-Za-z]+([-_/+=]+[A-Za-z]*)*$", r"^[0-9]+([-_/+=]+[0-9]*)*$"][pattern]
    for size in range(1, 6):
        for letters in itertools.product(parts + "-=_.", repeat=size):
            text = "".join(letters)
            assert bool(re.search(secrets.ALLOWED[pattern], text)) == bool(re.search(old, text)), text
