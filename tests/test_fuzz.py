"""Random input against plain Python and pandas models of the rules."""

import json
import random
import re

import numpy as np
import pandas as pd

from lakeloom.functions import cast, nested, text

ROWS = 3000


def run(spark, values, *expressions):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string").repartition(4)
    out = df.select("i", *[e.alias(f"e{n}") for n, e in enumerate(expressions)]).collect()
    return [tuple(r)[1:] for r in sorted(out)]


def test_numbers_like_pandas(spark):
    rng = random.Random(1)
    alphabet = ["0", "1", "9", "12", ".", "e", "E", "+", "-", " ", "inf", "x", "d", "_", ",", "\t", "0x", "nan", "5", "\n", "1e400", "Infinity"]
    values = ["".join(rng.choices(alphabet, k=rng.randint(1, 4))) for _ in range(ROWS)]
    expected = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").astype(float)
    got = [r[0] for r in run(spark, values, cast.lenient_double("c"))]
    bad = [(v, g, e) for v, g, e in zip(values, got, expected) if (np.nan if g is None else g) != e and not (g is None and np.isnan(e))]
    assert bad == []


def test_dates_like_pandas(spark):
    rng = random.Random(2)
    pieces = ["2020", "1999", "20", "-", "-", "1", "02", "30", "12", "/", " ", "T00:00:00", "29", "0"]
    values = ["".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(ROWS)]
    values += [f"{rng.randint(1700, 2200)}-{rng.randint(1, 13)}-{rng.randint(1, 32)}" for _ in range(ROWS)]
    expected = pd.to_datetime(pd.Series(values), format="%Y-%m-%d", errors="coerce").dt.strftime("%Y-%m-%d")
    got = [r[0] for r in run(spark, values, cast.iso_date("c"))]
    assert [(v, g, e) for v, g, e in zip(values, got, expected) if g != (None if pd.isna(e) else e)] == []


def test_text_like_python(spark):
    rng = random.Random(3)
    alphabet = list(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　​﻿") + list("abÉß_1-é漢٣'")
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(ROWS)]
    got = run(spark, values, text.strip("c"), text.clean("c"), text.word_count("c"), text.tokens("c"))
    for v, (strip, clean, words, tokens) in zip(values, got):
        assert strip == v.strip(), repr(v)
        assert clean == re.sub(r"\s+", " ", v.lower()).strip(), repr(v)
        assert words == len(v.split()), repr(v)
        assert tokens == re.findall(r"\b\w\w+\b", v.lower()), repr(v)


def names_model(cell, jobs=None):
    try:
        data = json.loads(cell)
        picked = [d["name"] for d in data if isinstance(d, dict) and (jobs is None or d.get("job") in jobs) and d.get("name")]
        return ", ".join(picked if jobs is None else dict.fromkeys(picked)) if isinstance(data, list) else ""
    except Exception:
        return ""


def test_json_like_python(spark):
    rng = random.Random(4)
    scalars = ["A", "B", "", "é, \"q\"", 0, 5, 1.5, 0.0, True, False, None, [], ["A"], {}, {"x": 1}]

    def item():
        kind = rng.random()
        if kind < 0.15:
            return rng.choice(scalars)
        name = rng.choice(["A", "B", "C"]) if rng.random() < 0.8 else rng.choice(scalars)
        d = {"name": name} if rng.random() < 0.9 else {}
        if rng.random() < 0.9:
            d["job"] = rng.choice(["Director", "Writer", "Editor"]) if rng.random() < 0.93 else rng.choice(scalars)
        return d

    def cell():
        kind = rng.random()
        if kind < 0.06:
            return rng.choice(["bad", "", "null", "[", "{}", '"x"', "5", "[1", "[{'name':'A'}]"])
        if kind < 0.1:
            return json.dumps(item())
        return json.dumps([item() for _ in range(rng.randint(0, 4))], ensure_ascii=rng.random() < 0.5)

    values = [cell() for _ in range(ROWS)]
    jobs = ["Director", "Writer"]
    got = run(spark, values, nested.json_names("c"), nested.json_names_by_role("c", jobs))
    bad = [(v, g, (names_model(v), names_model(v, set(jobs)))) for v, g in zip(values, got)
           if g != (names_model(v), names_model(v, set(jobs)))]
    assert bad == []
