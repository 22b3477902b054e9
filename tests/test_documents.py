import json
import random

import pytest

from shelfcast.sources import documents, tables

FIELDS = "a long, s string, l array<struct<x:long,y:string>>"


def odd_records(n, seed=1):
    rng = random.Random(seed)
    texts = ['}', '{', '],[', '\\', '\\"', '"', 'a,b', '\n', '', 'é日', '\\\\"}', "x" * 300, '"}{"', "\\u007b"]
    return [
        {"a": i, "s": "".join(rng.choice(texts) for _ in range(rng.randrange(6))),
         "l": [{"x": i, "y": rng.choice(texts)} for _ in range(rng.randrange(3))]}
        for i in range(n)
    ]


def plain(rows):
    return sorted((r["a"], r["s"], tuple((e["x"], e["y"]) for e in r["l"])) for r in rows)


@pytest.fixture()
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "150")
    spark.conf.set(names[1], "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("indent", [None, 1])
def test_array_of_many_splits_equals_the_line_form(spark, tmp_path, tiny_splits, indent):
    records = odd_records(60)
    for number, part in enumerate((records[:40], records[40:])):
        (tmp_path / f"array{number}.json").write_text(json.dumps(part, indent=indent, ensure_ascii=number == 0))
    path = str(tmp_path / "array*.json")
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    got = documents.read_json_array(spark, path, FIELDS, "cards").collect()
    assert plain(got) == plain(records)
    lines = tmp_path / "lines"
    lines.write_text("\n".join(json.dumps(r) for r in records))
    assert plain(got) == plain(tables.read_json_lines(spark, str(lines), FIELDS, "cards").collect())


def test_map_of_many_splits(spark, tmp_path, tiny_splits):
    records = odd_records(40, seed=2)
    # Keys that look like structure; an entry longer than several splits.
    table = {f'k{r["a"]},"}}{{': {"a": r["a"], "s": r["s"] * 3} for r in records}
    (tmp_path / "map.json").write_text("﻿" + json.dumps(table) + "\n")
    got = documents.read_json_map(spark, str(tmp_path / "map.json"), "a long, s string", "costs", "key").collect()
    assert sorted((r["key"], r["a"], r["s"]) for r in got) == sorted((k, v["a"], v["s"]) for k, v in table.items())


@pytest.mark.parametrize("text, size", [("[]", 0), ("{}", 0), (" [ ] \n", 0), ('[{"a":1}]', 1), ('[{"a":1},{"a":2}]}}', 2), ("", 0)])
def test_small_documents(spark, tmp_path, text, size):
    (tmp_path / "one.json").write_text(text)
    assert documents.read_json_array(spark, str(tmp_path / "one.json"), "a long", "one").count() == size


def test_cutting_at_every_place():
    """Any two splits of a document give the same elements."""
    import numpy as np

    records = odd_records(6, seed=3)
    data = json.dumps(records).encode() + b"}"
    pieces = [p + b"}" for p in data.split(b"}")[:-1]]
    for first in range(1, len(pieces)):
        chunks = [b"".join(pieces[:first]), b"".join(pieces[first:])]
        rows = []
        for start, chunk in enumerate(chunks):
            bytes_ = np.frombuffer(chunk, np.uint8)
            step, quoted = documents._STEP[bytes_].astype(int), documents._quoted(bytes_, False)
            rows.append({"path": "p", "start": start, "turned": int(quoted[-1]),
                         "outside": int(step[~quoted].sum()), "inside": int(step[quoted].sum())})
        states = documents._starts(rows)
        found = []
        for start, chunk in enumerate(chunks):
            cutter = documents._Cutter(*states["p", start])
            found += [*cutter.feed(chunk), *cutter.rest()]
        whole = b"".join(text + (b"\n" if kind in (documents._WHOLE, documents._HEAD) else b"") for kind, text in found)
        assert [json.loads(t) for t in whole.decode().split("\n") if t.strip()] == records
