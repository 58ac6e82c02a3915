"""Code-list extraction (SRC-3, SRC-5, SET-4, FLT-3)."""

from __future__ import annotations

import random
import re

import pytest

from starmart.plans.tables import build_origin
from starmart.sources.labels import code_list, label_blocks, label_entries
from tests.fixtures import LABEL_TEXT, write_text


@pytest.fixture()
def label_file(workdir):
    return write_text(workdir, "labels.SAS", LABEL_TEXT)


def _as_dict(df):
    return {r.code: r.label for r in df.collect()}


def test_country_block_edge_rows(spark, label_file):
    got = _as_dict(code_list(spark, label_file, "i94cntyl"))
    assert got == {
        "101": "ALPHALAND",
        "102": "BETA, REPUBLIC OF",       # comma inside the label, trailing blanks gone
        "103": "GAMMA ISLANDS",           # repeated code: last line wins
        "0": "INVALID: ZERO",             # kept, no validity filter (B17)
        "54": "No Country Code (54)",     # short codes stay unpadded (B18)
        "105": "DELTA",                   # terminator after the last entry
    }                                     # '104' has two '=' and is dropped


def test_port_block_quotes_tabs_and_own_line_terminator(spark, label_file):
    got = _as_dict(code_list(spark, label_file, "$i94prtl"))
    assert got == {
        "AAA": "ALPHA PORT, AK",
        "INT": "INTL FALLS, MN",          # doubled apostrophe disappears
        "BBB": "No PORT Code (BBB)",
    }


def test_all_blocks_in_one_pass(spark, label_file):
    blocks = {r.block: r.n for r in label_blocks(spark, label_file).groupBy("block").count().withColumnRenamed("count", "n").collect()}
    assert blocks == {"i94cntyl": 6, "i94prtl": 3, "i94model": 2}


def test_entries_keep_positions(spark, label_file):
    rows = label_entries(spark, label_file).where("block = 'i94cntyl' and code = '103'").orderBy("line_pos").collect()
    assert [r.label for r in rows] == ["GAMMA", "GAMMA ISLANDS"]


def test_missing_block_raises(spark, label_file):
    with pytest.raises(ValueError):
        code_list(spark, label_file, "i94addrl")


def test_origin_dimension_codes_are_integers(spark, label_file):
    origin = build_origin(spark, label_file)
    assert dict(origin.dtypes) == {"country_code": "int", "country_name": "string"}
    assert {r.country_code for r in origin.collect()} == {101, 102, 103, 0, 54, 105}


def test_many_files_parse_in_parallel(spark, workdir):
    for i in range(3):
        write_text(workdir, f"part{i}.SAS", f"value blk{i}\r\n {i} = 'L{i}' ;\r\n")
    got = {(r.block, r.code, r.label) for r in label_blocks(spark, workdir).collect()}
    assert got == {("blk0", "0", "L0"), ("blk1", "1", "L1"), ("blk2", "2", "L2")}


def test_first_block_of_a_name_wins_within_a_file(spark, workdir):
    text = "value dup\r\n 1 = 'first'\r\n;\r\nvalue dup\r\n 1 = 'second'\r\n 2 = 'x' ;\r\n"
    path = write_text(workdir, "dup.SAS", text)
    assert _as_dict(code_list(spark, path, "dup")) == {"1": "first"}


def plain_blocks(text):
    """What a reader of one whole file finds: block, code and label of the last line of a code."""
    text, found, out = text.replace("\t", ""), set(), {}
    for body in re.findall(r"(?m)^[ ]*value[ ]+\$?(\w+[^;]*);", text):
        name = re.match(r"\w+", body)[0]
        if name in found:
            continue
        found.add(name)
        for line in body.split("\n")[1:]:
            parts = line.replace("'", "").split("=")
            if len(parts) == 2:
                out[name, parts[0].strip()] = parts[1].strip()
    return {(name, code, label) for (name, code), label in out.items()}


def random_labels(rng, lines):
    """Blocks of any length, with the hard lines: doubled apostrophes, two ``=``, a
    second block of a name, headers inside a block, marks on lines of their own."""
    out = []
    for _ in range(lines):
        name, code = f"blk{rng.randrange(8)}", rng.randrange(50)
        out.append(
            rng.choice(
                [f" {code} = 'L{rng.randrange(99)}'"] * 12
                + [f"value {name}", f"  value ${name} ", f" value {name} extra = text", ";", f" {code} = 'end' ;", f"value {name} ;", f" {code} = 'INT''L, X'",
                   f" {code} = 'a' = 'b'", "", "no entry", f" '{code}'\t=\t' padded  ' ; value gone", f"valued {name}", f" {code} = ''"]
            )
        )
    return "\r\n".join(out) + rng.choice(["", ";", "\r\n"])


def test_files_are_split_inside_blocks(spark, workdir):
    rng, want = random.Random(3), {}
    for k, lines in enumerate((5, 60, 1500, 700)):
        text = random_labels(rng, lines)
        write_text(workdir, f"f{k}.SAS", text)
        want[f"f{k}.SAS"] = plain_blocks(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("300", "4000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            assert spark.read.text(workdir).rdd.getNumPartitions() > (50 if size == "300" else 0)
            for name, found in want.items():
                assert {tuple(r) for r in label_blocks(spark, f"{workdir}/{name}").collect()} == found, (size, name)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_block_without_an_end_is_none(spark, workdir):
    path = write_text(workdir, "open.SAS", "value done\r\n 1 = 'a' ;\r\nvalue open\r\n 2 = 'b'\r\nvalue done\r\n 3 = 'c'\r\n")
    assert {tuple(r) for r in label_blocks(spark, path).collect()} == {("done", "1", "a")}
