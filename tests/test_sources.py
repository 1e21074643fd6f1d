"""Strict and lenient reading: what is accepted, refused and raised."""

import csv
import io
import json
import random
import re
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.errors import IngestError
from orderflow.schema import DRIVER, ORDER, RESTAURANT, USER, Attr, Entity
from orderflow.sinks import files as sink
from orderflow.sources import chunks, files, records
from orderflow.sources.files import read_entity, text_lines

ITEM = Entity("item", (Attr("id", "long"), Attr("name")))


def put(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@contextmanager
def splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


A, B = "<item><id>1</id><name>a</name></item>", "<item><id>2</id><name>b</name></item>"


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("_pos").select(*columns).collect()]


def test_csv_strict_reads_positionally_and_keeps_quotes(spark, tmp_path):
    path = put(tmp_path, "i.csv", '1,a\n\n  \n2,"b"\n3,\n')
    assert rows(read_entity(spark, path, ITEM), "id", "name", "reject_reason") == [(1, "a", None), (2, '"b"', None), (3, "", None)]


@pytest.mark.parametrize("bad", ["1234", "1,a,b", "1,a,"])
def test_csv_strict_refuses_the_whole_file_but_not_its_neighbour(spark, tmp_path, bad):
    put(tmp_path, "d.csv/one", f"1,a\n{bad}\n2,b\n")
    put(tmp_path, "d.csv/two", "3,c\n")
    got = read_entity(spark, str(tmp_path / "d.csv"), ITEM)
    assert [r["id"] for r in got.filter("reject_reason IS NULL").collect()] == [3]
    assert [r[0] for r in got.filter("reject_reason IS NOT NULL").select("reject_reason").collect()] == ["field_count"] * 3


def test_csv_position_follows_the_file_over_many_splits(spark, tmp_path):
    path = put(tmp_path, "i.csv", "\n".join(f"{i},n{i}" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_entity(spark, path, ITEM)
        assert [r[0] for r in rows(df, "id")] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_user_flags_and_hyphens(spark, tmp_path):
    line = "698bb0dd-ef09-4f47-adf0-0cfa08a485bb,ROLE_ADMIN,p@ssw0rd,me@m.com,True,false,on,OFF,1"
    user = read_entity(spark, put(tmp_path, "u.csv", line), USER).first()
    assert user["id"] == "698bb0ddef094f47adf00cfa08a485bb"
    assert [user[c] for c in USER.columns[4:]] == [True, False, True, False, True]


@pytest.mark.parametrize(
    ("line", "field"),
    [
        ("x,R,p,e,True,True,True,True,True", "id"),
        ("698bb0ddef094f47adf00cfa08a485bb,R,p,e,True,True,perhaps,True,True", "account_non_expired"),
    ],
)
def test_strict_bad_value_raises_and_names_the_field(spark, tmp_path, line, field):
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "u.csv", line), USER)
    assert (e.value.reason, e.value.detail) == ("bad_value", field)


def test_json_strict(spark, tmp_path):
    text = json.dumps([{"id": 1, "name": "}, {"}, {"name": "line\nbreak", "id": "2", "more": [1]}], indent=4)
    assert rows(read_entity(spark, put(tmp_path, "i.json", text), ITEM), "id", "name") == [(1, "}, {"), (2, "line\nbreak")]


@pytest.mark.parametrize("text", ['{"bad":json}', '[{"id": 1, "name": "a"}', '[{"id":1},{bad}]', "[1, 2]"])
def test_json_malformed(spark, tmp_path, text):
    for strict in (True, False):
        with pytest.raises(IngestError) as e:
            read_entity(spark, put(tmp_path, "i.json", text), ITEM, strict=strict)
        assert e.value.reason == "malformed"


def test_json_empty_array(spark, tmp_path):
    assert read_entity(spark, put(tmp_path, "i.json", "[]"), ITEM).isEmpty()


def test_missing_field_raises_when_strict(spark, tmp_path):
    order = {"id": 1, "customer_id": "c", "restaurant_id": 2, "confirmation_code": "x"}
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "o.json", json.dumps([order])), ORDER)
    assert (e.value.reason, e.value.detail) == ("missing_field", "delivery_id")
    xml = "<items><item><id>1234</id></item></items>"
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "i.xml", xml), ITEM)
    assert (e.value.reason, e.value.detail) == ("missing_field", "name")


def test_xml_strict(spark, tmp_path):
    xml = '<?xml version="1.0" ?>\n<items>\n  <item>\n <name>a &lt; b</name><id>1</id></item><other/><item><id>2</id><name> c </name></item>\n</items>\n'
    assert rows(read_entity(spark, put(tmp_path, "i.xml", xml), ITEM), "id", "name") == [(1, "a < b"), (2, " c ")]


@pytest.mark.parametrize(
    "xml",
    [
        "<items><item><id>1</id><name>a</name></item></items",
        "<items><item><id>1</id><name>a</name></item>",
        "<items><item><id>1</id><name>a</item></items>",
        "<items><item><id>1</id><name>a</name></item></others>",
        "nothing",
    ],
)
@pytest.mark.parametrize("layout", records.LAYOUTS)
def test_xml_malformed(spark, tmp_path, xml, layout):
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "i.xml", xml), ITEM, layout=layout)
    assert e.value.reason == "malformed"


def _items(n):
    return [{"id": i, "name": f"n{i} }}, \n {{ </item"} for i in range(n)]


def _as_lines(items):
    return "[\n" + ",\n".join(json.dumps(i) for i in items) + "\n]\n"


@pytest.mark.parametrize("layout", [lambda x: json.dumps(x, indent=4), lambda x: json.dumps(x, indent=1), _as_lines])
def test_large_json_is_split_and_equal(spark, tmp_path, layout):
    path = put(tmp_path, "i.json", layout(_items(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = records.json_records(spark, path, layout="records")
        assert raw.select(F.spark_partition_id()).distinct().count() > 1
        split = rows(read_entity(spark, path, ITEM, layout="records"), "id", "name")
        assert split == rows(read_entity(spark, path, ITEM), "id", "name")
        assert len(split) == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    "text",
    [
        '[\n{"id": 1, "name": "a"},\n{"id": 2, "name": "b"}\n',
        '[\n{"id": 1, "name": "a"}\n{"id": 2, "name": "b"}\n]',
        '[\n{"id": 1, "name": "a"},\n{"id": 2, "name": "b"},\n]',
        '[\n{"id": 1, "name": "a"},\n]\n[\n{"id": 2, "name": "b"}\n]',
        '[\n  {\n    "id": 1,\n    "name": "a"\n  },\n  {\n    "id": 2,\n    "name": "b"\n  }\n',
        '[\n  {\n    "id": 1,\n    "name": "a"\n  }\n  {\n    "id": 2,\n    "name": "b"\n  }\n]',
    ],
)
def test_large_json_damage_is_noticed(spark, tmp_path, text):
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "i.json", text), ITEM, layout="records")
    assert e.value.reason == "malformed"


def test_json_of_any_layout_is_split(spark, tmp_path):
    """In one line, with nested objects, brackets in texts and escaped quotes."""
    items = [{"id": i, "more": {"a": [{}, [{"}": "]"}]]}, "name": f'n{i} \\ "}}{{[\n'} for i in range(400)]
    with splits(spark, 2000):
        for k, indent in enumerate((None, 0, 3)):
            path = put(tmp_path, f"{k}.json", json.dumps(items, indent=indent))
            raw = spark.read.text(path, lineSep="}")
            assert raw.select(F.spark_partition_id()).distinct().count() > 5
            got = read_entity(spark, path, ITEM, layout="records")
            assert rows(got, "id", "name") == [(i["id"], i["name"]) for i in items]
            assert got.select("_pos").distinct().count() == len(items)


def test_a_record_longer_than_a_block(spark, tmp_path):
    with splits(spark, 500):
        path = put(tmp_path, "i.json", json.dumps([{"id": 1, "name": "}" * 3000}, {"id": 2, "name": "y"}]))
        assert rows(read_entity(spark, path, ITEM, layout="records"), "id", "name") == [(1, "}" * 3000), (2, "y")]
        path = put(tmp_path, "i.csv", '1,"' + 'a ""b"",\n' * 700 + '"\n2,b\n')
        assert rows(read_entity(spark, path, ITEM, quoted=True), "id", "name") == [(1, 'a "b",\n' * 700), (2, "b")]
        path = put(tmp_path, "i.xml", "<r><a><name>" + "<!-- <b> -->x<![CDATA[</a>]]>" * 100 + "</name><id>1</id></a>" + B + "</r>")
        assert rows(read_entity(spark, path, ITEM, strict=False, layout="records"), "id", "name") == [(1, "x</a>" * 100), (2, "b")]


@pytest.mark.parametrize("text", ['[{"id":1,"name":"a"}]}', '[{"id":1,"name":"a"} {"id":2,"name":"b"}]', '[1, "}", 2]', '[{"id":1,"name":"a}]', '[{"id":1,"name":"a"}][]', '[[{"id":1,"name":"a"}]]'])
def test_damaged_arrays_raise_when_split(spark, tmp_path, text):
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "i.json", text), ITEM, layout="records")
    assert e.value.reason == "malformed"


@pytest.mark.parametrize("text", ["[]", " [ \n ] ", "", "\n\n"])
def test_empty_arrays_split(spark, tmp_path, text):
    assert read_entity(spark, put(tmp_path, "i.json", text), ITEM, layout="records").isEmpty()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=4, max_size=4), st.lists(st.integers(-2, 2), min_size=4, max_size=4)), min_size=1, max_size=40))
def test_effects_compose_like_a_walk(pieces):
    after, depth = chunks.prefix_effects(np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces]))
    for start in range(4):
        state, deep = start, 0
        for k, (to, change) in enumerate(pieces):
            state, deep = to[state], deep + change[state]
            assert (after[k, start], depth[k, start]) == (state, deep)


def test_large_quoted_csv_is_split_like_the_csv_module_reads_it(spark, tmp_path):
    rnd = random.Random(4)
    items = [(i, "".join(rnd.choice('ab,"\n ') for _ in range(rnd.randrange(30)))) for i in range(700)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(items)
    path = put(tmp_path, "i.csv", out.getvalue() + '700,5" pipe, no\n'.replace(", no", ""))
    with splits(spark, 1500):
        assert spark.read.text(path).select(F.spark_partition_id()).distinct().count() > 5
        assert rows(read_entity(spark, path, ITEM, quoted=True), "id", "name") == [*items, (700, '5" pipe')]
        head = put(tmp_path, "h.csv", "name,note,id\n" + "".join(f'"{n.replace(chr(34), chr(34) * 2)}",x,{i}\n' for i, n in items))
        assert rows(read_entity(spark, head, ITEM, strict=False), "id", "name", "reject_reason") == [(i, n, None) for i, n in items]


def test_an_open_quote_refuses_the_file(spark, tmp_path):
    for strict, more in ((True, {"quoted": True}), (False, {})):
        with pytest.raises(IngestError) as e:
            read_entity(spark, put(tmp_path, "i.csv", '1,"a\n2,b\n3,c\n'), ITEM, strict=strict, **more)
        assert e.value.reason == "malformed"


def test_children_of_any_tag_are_split(spark, tmp_path):
    body = "".join(f"<t{i % 3} k='>'><id>{i}</id><name>n{i} &lt; > <![CDATA[</t>]]></name></t{i % 3}> between <!-- <t> -->\n<!-- {'x' * 700 if i == 200 else ''} -->" for i in range(400))
    path = put(tmp_path, "i.xml", f'<?xml version="1.0"?>\n<!-- a\n<b> -->\n<items v="1>2">{body}</items>\n<!-- end -->\n')
    with splits(spark, 3000):
        assert spark.read.text(path, lineSep="<").select(F.spark_partition_id()).distinct().count() > 5
        split = rows(read_entity(spark, path, ITEM, strict=False, layout="records"), "id", "name")
    assert split == [(i, f"n{i} < > </t>") for i in range(400)]
    assert split == rows(read_entity(spark, path, ITEM, strict=False), "id", "name")


@pytest.mark.parametrize("xml", ["<r>{}", "<r>{}</s>", "{}{}", "<r>{}</r><r>{}</r>", "x<r>{}</r>", "<r>{}</r>x", "<r>{}</r", "<r><!-- {}</r>", "<r>{}<id>1</name></r>", "<r><a><id>1</id><name>a < b</name></a></r>", "nothing", "<!-- {} -->"])
def test_broken_documents_raise_when_split(spark, tmp_path, xml):
    with pytest.raises(IngestError) as e:
        read_entity(spark, put(tmp_path, "i.xml", xml.format(A, B)), ITEM, strict=False, layout="records")
    assert e.value.reason == "malformed"


def test_large_xml_is_split_and_equal(spark, tmp_path):
    body = "\n".join(f"    <item>\n        <id>{i}</id>\n        <name>n{i} &lt;/item&gt;</name>\n    </item>" for i in range(400))
    path = put(tmp_path, "i.xml", f'<?xml version="1.0" ?>\n<items>\n{body}\n</items>\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        split = rows(read_entity(spark, path, ITEM, layout="records"), "id", "name")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert split == rows(read_entity(spark, path, ITEM), "id", "name")
    assert len(split) == 400


HEAD = "city,street,state,zip,owner_id,name,rating,price_category,phone,is_active,picture"
FIRST = "Phoenix,Ap 1,AZ,05084,1,My Rest,5,1,407-455-4527,1,https://x"
SECOND = 'Springs,"773, Nam",WY,56413,1,Other,3.5,2,555-555-5555,0,'


def test_lenient_csv_header_decides_the_order(spark, tmp_path):
    path = put(tmp_path, "r.csv", f"{HEAD}\n{FIRST}\n{SECOND}\nshort,row\n{FIRST},extra\n")
    got = rows(read_entity(spark, path, RESTAURANT, strict=False), "street", "city", "zip", "rating", "picture", "reject_reason")
    assert got == [
        ("Ap 1", "Phoenix", "05084", 5.0, "https://x", None),
        ("773, Nam", "Springs", "56413", 3.5, "", None),
        (None, None, None, None, None, "short_row"),
        ("Ap 1", "Phoenix", "05084", 5.0, "https://x", None),
    ]


def test_lenient_csv_without_header_keeps_the_first_row(spark, tmp_path):
    path = put(tmp_path, "r.csv", f"{FIRST}\n{SECOND}\n")
    got = rows(read_entity(spark, path, RESTAURANT, strict=False), "street", "city", "reject_reason")
    assert got == [("Phoenix", "Ap 1", None), ("Springs", "773, Nam", None)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_lenient_csv_header_holds_for_its_own_file_and_first_row_alone(spark, tmp_path, multi_line):
    put(tmp_path, "r.csv/a [1]", f"{HEAD}\n{FIRST}\n{HEAD}\n")
    put(tmp_path, "r.csv/b", HEAD.replace("city,street", "street,city") + f"\n{FIRST}\n")
    put(tmp_path, "r.csv/c", f"{SECOND}\n")
    found = read_entity(spark, str(tmp_path / "r.csv"), RESTAURANT, strict=False, multi_line=multi_line)
    assert sorted(tuple(r) for r in found.select("street", "city", F.coalesce("reject_reason", F.lit(""))).collect()) == [
        ("Ap 1", "Phoenix", ""),
        ("Phoenix", "Ap 1", ""),
        ("Springs", "773, Nam", ""),
        ("street", "city", "bad_value"),
    ]
    assert found.select("_pos").distinct().count() == 4


def test_lenient_csv_values_may_hold_line_breaks(spark, tmp_path):
    path = put(tmp_path, "r.csv", f"{FIRST}\n" + FIRST.replace("Ap 1", '"Ap\n""1"""') + "\n")
    got = rows(read_entity(spark, path, RESTAURANT, strict=False), "street", "city", "reject_reason")
    assert got == [("Phoenix", "Ap 1", None), ("Phoenix", 'Ap\n"1"', None)]


def test_lenient_empty_csv_is_an_empty_table(spark, tmp_path):
    assert read_entity(spark, put(tmp_path, "r.csv", ""), RESTAURANT, strict=False).isEmpty()


def test_lenient_json_skips_one_entry(spark, tmp_path):
    full = dict.fromkeys(DRIVER.columns, "1")
    entries = [full, {k: v for k, v in full.items() if k != "phone"}, {**full, "rating": "high"}, {**full, "note": 1}]
    got = rows(read_entity(spark, put(tmp_path, "d.json", json.dumps(entries)), DRIVER, strict=False), "reject_reason", "reject_detail")
    assert got == [(None, None), ("missing_field", "phone"), ("bad_value", "rating"), (None, None)]


@pytest.mark.parametrize("name", ["file.txt", "file.CSV", "file"])
def test_unsupported_extension(spark, name):
    with pytest.raises(IngestError) as e:
        read_entity(spark, name, ITEM)
    assert e.value.reason == "unsupported_format"


def test_text_lines(spark, tmp_path):
    path = put(tmp_path, "names.txt", "Ann\nBob\n")
    assert sorted(r["name"] for r in text_lines(spark, path).collect()) == ["Ann", "Bob"]


@pytest.mark.parametrize(("name", "text", "whole"), [("i.xml", "<items><item><id>1</id><name>a</name></item></items>", "_doc"), ("i.json", '[{"id":1,"name":"a"}]', "_raw")])
def test_exploded_rows_do_not_carry_their_document(spark, tmp_path, name, text, whole):
    from orderflow.sources.files import raw_rows, type_rows

    df = type_rows(raw_rows(spark, put(tmp_path, name, text), ITEM), ITEM)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above, generate = plan.split("Generate explode(")[0], plan.split("Generate explode(")[1].split("\n")[0]
    assert whole + "#" not in above.split("\n")[-2] and "), [" in generate  # the array itself is dropped


def _read(spark, path, layout):
    try:
        return rows(read_entity(spark, path, ITEM, layout=layout), "id", "name")
    except IngestError as e:
        return e.reason


BOTH = [(1, "a"), (2, "b")]


@pytest.mark.parametrize(
    ("xml", "whole", "split"),
    [
        (f"<items>{A}{B}</items>", BOTH, BOTH),
        (f"<items><!-- one -->{A}<!-- two\n -->{B}<!-- three --></items>", BOTH, BOTH),
        (f"<items>{A.replace('</item>', '</item >')}{B}</items>", BOTH, "malformed"),
        (f"<items>{A}{B.replace('</item>', '</item >')}</items>", BOTH, "malformed"),
        (f"<items>{A}<!-- {B} -->{B}</items>", BOTH, "malformed"),
        (f"<items>{A}<other/>{B}</items>", BOTH, "malformed"),
        ("", [], []),
    ],
)
def test_no_xml_layout_loses_rows(spark, tmp_path, xml, whole, split):
    path = put(tmp_path, "i.xml", xml)
    assert _read(spark, path, "document") == whole
    assert _read(spark, path, "records") == split


def test_lenient_xml_takes_every_child_of_the_root(spark, tmp_path):
    xml = """<?xml version="1.0"?><items v="1">{}<other><name>a &lt; b &amp;amp; c</name><id k='x"y' m="it's &gt;">3</id></other> text <!-- <item/> -->
        <third a='p"q'><id>4</id><name><![CDATA[<x> & &lt; <![CDATA[ "]]></name></third>{}<other><id>5</id></other><item/></items>"""
    path = put(tmp_path, "i.xml", xml.format(A, B))
    got = rows(read_entity(spark, path, ITEM, strict=False), "id", "name", "reject_reason", "reject_detail")
    texts = {3: "a < b &amp; c", 4: '<x> & &lt; <![CDATA[ "'}
    assert got[:4] == [(1, "a", None, None), (3, texts[3], None, None), (4, texts[4], None, None), (2, "b", None, None)]
    assert got[4:] == [(5, None, "missing_field", "name"), (None, None, "missing_field", "id")]
    assert rows(read_entity(spark, path, ITEM, strict=False, layout="records"), "id", "name", "reject_reason", "reject_detail") == got
    for layout in records.LAYOUTS:
        with pytest.raises(IngestError) as e:
            read_entity(spark, put(tmp_path, "j.xml", xml.format(A, "<other><name>a & b</name></other>")), ITEM, strict=False, layout=layout)
        assert e.value.reason == "malformed"


def test_every_json_file_of_a_directory_has_its_own_layout(spark, tmp_path):
    put(tmp_path, "d.json/a", '[{"id": 1, "name": "a"}]')
    put(tmp_path, "d.json/b", '{"id": 2, "name": "b"}\n\n{"id": 3, "name": "c"}\n')
    put(tmp_path, "d.json/c", "\n")
    got = read_entity(spark, str(tmp_path / "d.json"), ITEM)
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError):
        read_entity(spark, put(tmp_path, "i.json", "[]"), ITEM, layout="large")


def test_lenient_csv_line_break_inside_quotes(spark, tmp_path):
    path = put(tmp_path, "r.csv", f"{HEAD}\n" + FIRST.replace("Ap 1", '"12 Main\nStreet"') + f"\n{SECOND}\n")
    got = rows(read_entity(spark, path, RESTAURANT, strict=False), "street", "city", "reject_reason")
    assert got == [("12 Main\nStreet", "Phoenix", None), ("773, Nam", "Springs", None)]


def test_strict_csv_quoted(spark, tmp_path):
    path = put(tmp_path, "i.csv", '1,"a, ""b"""\n2,"c\nd"\n3,\n')
    assert rows(read_entity(spark, path, ITEM, quoted=True), "id", "name") == [(1, 'a, "b"'), (2, "c\nd"), (3, "")]


def test_documents_hold_a_bounded_number_of_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "FILE_RECORDS", 3)
    made = spark.range(0, 20, 1, 2).select("id", F.concat(F.lit("n"), "id").alias("name"))
    for name, layout in (("i.xml", "lines"), ("i.json", "array")):
        path = tmp_path / name
        sink.write_entity(made, str(path), ITEM, layout=layout)
        texts = [p.read_text() for p in sorted(path.glob("part-*"))]
        if layout == "array":
            found = [[r["id"] for r in json.loads(t)] for t in texts]
        else:
            found = [[int(i) for i in re.findall(r"<id>(\d+)</id>", t)] for t in texts]
        assert [len(f) for f in found] == [3, 3, 3, 1] * 2
        assert sum(found, []) == list(range(20))
        assert sorted(r["id"] for r in read_entity(spark, str(path), ITEM).collect()) == list(range(20))
    sink.write_entity(made.limit(0), str(tmp_path / "none.json"), ITEM, layout="array")
    assert read_entity(spark, str(tmp_path / "none.json"), ITEM).count() == 0


def test_json_lines_are_split_and_arrays_beside_them_are_whole(spark, tmp_path):
    lines = "".join(f'{{"id": {i}, "name": "[{i}"}}\n' for i in range(200))
    put(tmp_path, "d.json/lines", lines)
    with splits(spark, 1000):
        alone = records.json_records(spark, str(tmp_path / "d.json"))
        assert alone.rdd.getNumPartitions() > 3
        put(tmp_path, "d.json/an array", " \n[\n" + ",\n".join(f'{{"id": {i}, "name": "b"}}' for i in range(200, 300)) + ", null]")
        put(tmp_path, "d.json/blank", " \n \n")
        got = read_entity(spark, str(tmp_path / "d.json"), ITEM)
        found = got.select("id", "_pos", "_file").collect()
    assert sorted(r["id"] for r in found) == list(range(300)) and len({r["_pos"] for r in found}) == 300
    own = sorted((r["_pos"], r["id"]) for r in found if r["_file"].endswith("lines"))
    assert [i for _, i in own] == list(range(200))


def test_files_of_one_block_are_read_once(spark, tmp_path, monkeypatch):
    text = '[{"id": 1, "name": "}, [{"}, {"id": 2, "name": "\\"]"}]'
    path = put(tmp_path, "i.json", text)
    monkeypatch.setattr(chunks, "block_starts", lambda sums: pytest.fail("summed up first"))
    assert rows(read_entity(spark, path, ITEM, layout="records"), "id", "name") == [(1, "}, [{"), (2, '"]')]
    with pytest.raises(IngestError, match="malformed"):
        read_entity(spark, put(tmp_path, "j.json", text[:-1]), ITEM, layout="records")


def test_each_text_is_cast_once(spark):
    entity = Entity("x", (Attr("n", "long"), Attr("k", "hex"), Attr("t")))
    rows = spark.createDataFrame([("5", "{A-b}", "x"), ("1_0", "c", "y"), (None, "d", "z"), ("99999999999999999999", "e", "w")], "n string, k string, t string")
    rows = rows.select("*", *[F.lit(None).cast(k).alias(c) for c, k in (("_mark", "string"), ("_file", "string"), ("_pos", "long"), ("reject_reason", "string"), ("reject_detail", "string"))])
    typed = files.type_rows(rows, entity)
    assert [(r.n, r.k, r.t, r.reject_reason, r.reject_detail) for r in typed.collect()] == [
        (5, "ab", "x", None, None),
        (None, "c", "y", "bad_value", "n"),
        (None, "d", "z", "missing_field", "n"),
        (None, "e", "w", "bad_value", "n"),
    ]
    # the plan over rows that it does not know, so that nothing is folded away
    unknown = spark.range(1).select(*[F.col("id").cast("string").alias(c) for c in "nkt"], *[F.lit(None).cast("string").alias(c) for c in ("_mark", "_file", "reject_reason", "reject_detail")], F.col("id").alias("_pos"))
    plan = files.type_rows(unknown, entity)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == 1 and plan.count("regexp_replace(") == 1


def test_json_arrays_are_put_together_by_arrow():
    def batch(*lines):
        return pa.record_batch([pa.array(lines, pa.string())], ["value"])

    def arrays(*batches):
        return [t.column(0).to_pylist() for t in sink._bracketed(iter(batches), 2)]

    assert arrays() == [["[", "]"]] and arrays(batch(), batch("a")) == [["[", "a", "]"]]
    assert arrays(batch("a"), batch("b", "c", "d"), batch("\u00e4,")) == [["[", "a,", "b", "]"], ["[", "c,", "d", "]"], ["[", "\u00e4,", "]"]]
    assert arrays(batch("a", "b")) == [["[", "a,", "b", "]"]]
