import json

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.operators.nested import CATALOG_KINDS, extract_nodes, flat_table, flatten_records


def brute(payload):
    rows = []

    def load(s):
        try:
            return json.loads(s)
        except ValueError:
            return None

    def member(kind, v, parent):
        if isinstance(v, str) and v.strip()[:1] in ("{", "[") and load(v) is not None:
            return member(kind, load(v), parent)
        if isinstance(v, list):
            for i, x in enumerate(v):
                element(kind, x, parent, i)
        else:
            element(kind, v, parent, 0)
        return None

    def element(kind, v, parent, i):
        path = (parent + "." if parent else "") + f"{kind}[{i}]"
        if isinstance(v, str) and v.strip()[:1] in ("{", "[") and load(v) is not None:
            return element(kind, load(v), parent, i)
        if isinstance(v, dict):
            if any(x is not None for x in v.values()):
                rows.append((parent, path))
                for k in CATALOG_KINDS.within.get(kind, ()):
                    if k in v:
                        member(k, v[k], path)
        elif kind == "redirect" and not isinstance(v, bool) and (isinstance(v, str) and v.strip() or isinstance(v, int | float)):
            rows.append((parent, path))
        return None

    top = json.loads(payload)
    for k in CATALOG_KINDS.top:
        if k in top:
            member(k, top[k], "")
    return rows


def found(*payloads):
    record, columns = extract_nodes(pa.array(payloads, pa.string()))
    return sorted(zip(record.tolist(), columns["parent_path"].to_pylist(), columns["node_path"].to_pylist(), strict=True))


def test_shapes():
    assert found('{"redirect": [{"id": 1, "urls": {"latest": "x"}}, null, {}, "7", 8, " ", {"id": null}]}') == [(0, "", "redirect[0]"), (0, "", "redirect[3]"), (0, "", "redirect[4]"), (0, "redirect[0]", "redirect[0].urls[0]")]
    assert found('{"location": "{\\"country_code\\": \\"XA\\", \\"bounding_box\\": {\\"minimum_latitude\\": 1}}"}') == [(0, "", "location[0]"), (0, "location[0]", "location[0].bounding_box[0]")]
    assert found('{"redirect": "[5, {\\"id\\": \\"6\\"}]"}') == [(0, "", "redirect[0]"), (0, "", "redirect[1]")]
    assert found('{"x": {"urls": {"latest": "no"}}, "urls": [{}, {"latest": "y"}]}') == [(0, "", "urls[1]")]


def test_repeated_keys_last_counts():
    assert found('{"urls": {"latest": "x"}, "urls": null}') == []
    assert found('{"urls": null, "urls": {"latest": "x"}}') == [(0, "", "urls[0]")]


def test_strings_with_structure_in_them():
    assert found('{"urls": {"latest": "a\\"}]{,:\\\\"}, "name": "{\\"urls\\": 1}"}') == [(0, "", "urls[0]")]


def test_broken_payloads_give_nothing_and_harm_no_others():
    good = '{"urls": {"latest": "x"}}'
    assert found(None, "", "  ", "{", "}{", '{"urls": {"latest": "x}}', "[1,2", "nonsense", good, "[]", "5") == [(8, "", "urls[0]")]


_json = st.recursive(st.none() | st.integers(-5, 5) | st.text(alphabet='ab"\\{}[],: é', max_size=5), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["id", "urls", "redirect", "location", "bounding_box", "comment"]), c, max_size=4), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["urls", "redirect", "location", "x"]), _json, max_size=4), max_size=4), st.sampled_from([None, 1]))
def test_against_brute_force(records, indent):
    texts = [json.dumps(r, indent=indent, ensure_ascii=bool(indent)) for r in records]
    assert found(*texts) == sorted((i, a, b) for i, t in enumerate(texts) for a, b in brute(t))


def test_fields_and_flat_tables(spark):
    df = spark.createDataFrame([(1, '{"location": [{"country_code": "X\\u0041", "bounding_box": {"minimum_latitude": "1.5", "maximum_latitude": 2, "extracted_on": null}}]}', "a"), (1, '{"redirect": 9}', "b"), (2, None, "c")], "record_id int, payload string, kind string")
    nodes = flatten_records(df, "record_id", "payload")
    assert flat_table(nodes, "record_id", "location", {"country_code": "string", "municipality": "string"}).collect() == [(1, "", "location[0]", "XA", None)]
    assert flat_table(nodes, "record_id", "bounding_box", {"minimum_latitude": "double", "maximum_latitude": "double"}).collect() == [(1, "location[0]", "location[0].bounding_box[0]", 1.5, 2.0)]
    assert flat_table(nodes, "record_id", "redirect", {"id": "string"}).collect() == [(1, "", "redirect[0]", "9")]
    assert flatten_records(df.limit(0), "record_id", "payload").count() == 0


def test_deep_nesting():
    text = '{"id": 1}'
    for i in range(200):
        text = f'{{"id": {i}, "redirect": [{text}]}}'
    assert len(found(f'{{"redirect": {text}}}')) == 201


def test_escaped_keys_are_recognised():
    top = CATALOG_KINDS.top[0]
    kind, inner = next((k, names[0]) for k, names in CATALOG_KINDS.within.items() if names and k in CATALOG_KINDS.top)
    plain = json.dumps({"note": "a\\b", top: {"x": 1}, kind: {"y": "q\"", inner: {"z": 2}}})
    escaped = plain
    for name in {top, kind, inner}:
        escaped = escaped.replace(f'"{name}"', f'"\\u{ord(name[0]):04x}{name[1:]}"')
    assert escaped != plain and json.loads(escaped) == json.loads(plain)
    want, got = (sorted(map(str, pa.table(c).to_pylist())) for _, c in (extract_nodes(pa.array([t, '{"a\\"b": 1}'])) for t in (plain, escaped)))
    assert len(want) >= 2 and want == got
