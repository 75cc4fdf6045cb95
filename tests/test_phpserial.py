"""Golden corpus and property tests for the per-value serialized → JSON rule."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions.phpserial import decode, php_to_json

# Golden corpus: input → expected text ("E" = a one-key {"error": …} object).
GOLDEN = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("i:5;", "5"), ("i:-7;", "-7"),
    ("d:0.5;", "0.5"), ("d:3;", "3.0"), ("b:1;", "true"), ("b:0;", "false"), ("N;", "null"),
    ('s:3:"abc";', '"abc"'), ('s:0:"";', '""'), ('s:6:"日本";', '"\\u65e5\\u672c"'),
    ('s:5:"a";b";', "E"), ('s:4:"a";b";', '"a\\";b"'), ("a:0:{}", "{}"),
    ('a:2:{i:0;s:1:"x";i:1;s:1:"y";}', '{"0": "x", "1": "y"}'),
    ('a:1:{s:1:"k";a:1:{s:1:"n";N;}}', '{"k": {"n": null}}'),
    ('a:1:{s:1:"k";s:9:"short";}', "E"), ('O:8:"stdClass":0:{}', "E"), ("a:hello", "E"),
    ("i: note", "E"), ('C:3:"Foo":0:{}', 'C:3:"Foo":0:{}'), ("i:5;trailing", "5"),
    ('a:2:{i:0;s:1:"a";i:0;s:1:"b";}', '{"0": "b"}'),          # later duplicate key wins
    ('a:1:{a:0:{}s:1:"v";}', "E"),                            # an array cannot be a key
    ("d:1e3;", "1000.0"), ("d:NAN;", "NaN"), ("d:-INF;", "-Infinity"),
    ('a:3:{i:1;b:1;d:1.5;N;b:1;s:1:"t";}', '{"1": "t", "1.5": null}'),  # 1 and true are one key
    ("i:99999999999999999999999;", "99999999999999999999999"),
    ("i:+007;", "7"), ("b:-3;", "true"), ("a:-1:{}", "{}"),
    ('s:-1:"";', "E"), ("N", "N"), ("N:1;", "N:1;"), ("a:1:{", "E"),
]


def test_golden():
    for text, want in GOLDEN:
        got = php_to_json(text)
        if want == "E":
            assert list(json.loads(got)) == ["error"], (text, got)
        else:
            assert got == want, (text, got)


def test_strict_json_drops_non_finite():
    assert php_to_json("d:NAN;", strict_json=True) == "null"
    assert php_to_json('a:1:{i:0;d:INF;}', strict_json=True) == '{"0": null}'


def test_deep_nesting_is_kept():
    deep = "a:1:{i:0;" * 500 + "N;" + "}" * 500
    assert list(json.loads(php_to_json(deep))) == ["0"]


def ser(v) -> str:
    if v is None:
        return "N;"
    if isinstance(v, bool):
        return f"b:{int(v)};"
    if isinstance(v, int):
        return f"i:{v};"
    if isinstance(v, float):
        return f"d:{v!r};"
    if isinstance(v, str):
        return f's:{len(v.encode())}:"{v}";'
    if isinstance(v, list):
        return f"a:{len(v)}:{{" + "".join(ser(i) + ser(x) for i, x in enumerate(v)) + "}"
    if isinstance(v, dict):
        return f"a:{len(v)}:{{" + "".join(ser(k) + ser(x) for k, x in v.items()) + "}"
    raise TypeError(v)


def as_json_value(v):
    if isinstance(v, list):
        return {str(i): as_json_value(x) for i, x in enumerate(v)}
    if isinstance(v, dict):
        return {str(k): as_json_value(x) for k, x in v.items()}
    return v


scalars = (st.none() | st.booleans() | st.integers(-10**20, 10**20)
           | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=20))
values = st.recursive(scalars, lambda inner: st.lists(inner, max_size=4)
                      | st.dictionaries(st.text(min_size=1, max_size=6).filter(lambda s: not s.isdigit()),
                                        inner, max_size=4), max_leaves=20)


@settings(max_examples=300, deadline=None)
@given(values)
def test_roundtrip_property(v):
    text = ser(v)
    out = php_to_json(text)
    if text.startswith(("a:", "s:", "i:", "d:", "b:", "N;")):
        assert json.loads(out) == as_json_value(v)
        assert out.isascii()


@settings(max_examples=300, deadline=None)
@given(values, st.integers(min_value=0, max_value=400))
def test_truncation_never_raises(v, cut):
    text = ser(v)[:cut]
    out = php_to_json(text)
    assert isinstance(out, str)


def test_decode_returns_python_values():
    assert decode('a:2:{s:1:"a";i:1;i:7;a:0:{}}') == {"a": 1, 7: {}}


def test_nesting_has_no_limit():
    for depth in (99, 101, 250, 20_000):
        text = 'a:2:{s:1:"k";i:1;i:0;' * depth + "N;" + "}" * depth
        want = '{"k": 1, "0": ' * depth + "null" + "}" * depth
        assert php_to_json(text) == want
    bad = 'a:1:{i:0;' * 300 + "d:inf;" + "}" * 300
    assert "Infinity" in php_to_json(bad) and "null" in php_to_json(bad, strict_json=True)
    assert php_to_json("a:1:{" * 300 + "}" * 300).startswith('{"error": ')
