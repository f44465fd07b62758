"""Fixity audit against a direct comparison of records."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from stratastar.llm import fixity

SCHEMA = "page_id long, url string, html string"


def record(url, html):
    html = html or ""
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nContent-Length: {len(html.encode())}\r\n\r\n{html}\r\n\r\n".encode()


def offsets(rows):
    at, out = {}, {}
    for i, url, html in sorted(r for r in rows if r[0] is not None):
        file = i // fixity.RANGE // fixity.FANOUT
        size = len(record(url, html))
        out[i] = (at.get(file, 0), size, hashlib.sha256(record(url, html)).hexdigest())
        at[file] = at.get(file, 0) + size
    return out


def expected(one, two):
    a, b = offsets(one), offsets(two)
    out = {}
    for i in a.keys() | b.keys():
        if a.get(i, (0, 0, None))[2] != b.get(i, (0, 0, None))[2]:
            state = "added" if i not in a else "missing" if i not in b else "changed"
            out[i] = (state, *(a.get(i) or b.get(i))[:2])
    return out


def found(spark, one, two):
    frames = [spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("clash")).repartition(3) for rows in (one, two)]
    return {r.id: (r.state, r.offset, r.length) for r in fixity.audit(*frames).collect()}


@pytest.mark.parametrize(("ranges", "fanout"), [(64, 1024), (4, 3)])
def test_damage_is_located(spark, monkeypatch, ranges, fanout):
    monkeypatch.setattr(fixity, "RANGE", ranges)
    monkeypatch.setattr(fixity, "FANOUT", fanout)
    one = [(i * 3 - 90, f"http://x/{i}", "é" * (i % 40)) for i in range(150)] + [(10**12, "far", "x" * 100_000), (None, "no", "id")]
    two = [r for r in one if r[0] != 0]
    two = [(i, u, (h or "") + "!" if i in (3, 300, 10**12) else h) for i, u, h in two] + [(-5000, "new", None)]
    assert found(spark, one, two) == expected(one, two)


def test_equal_replicas_and_nulls(spark):
    one = [(1, None, None), (2, "u", ""), (None, None, None)]
    assert found(spark, one, [(1, "", ""), (2, "u", None)]) == {}
    assert set(found(spark, one, [])) == {1, 2} and set(found(spark, [], one)) == {1, 2}
    assert found(spark, [], []) == {}


def test_repeated_records(spark):
    one = [(1, "u", "a"), (1, "u", "a"), (1, "u", "b"), (2, "u", "c")]
    assert found(spark, one, list(reversed(one))) == {}
    assert {i: x[0] for i, x in found(spark, one, [(1, "u", "a"), (1, "u", "b"), (1, "u", "b"), (2, "u", "c")]).items()} == {1: "changed"}
    assert {i: x[0] for i, x in found(spark, one, [one[0], one[2], one[3]]).items()} == {1: "changed"}
