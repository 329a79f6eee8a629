import pytest

from topicstream.options import (
    DEFAULT_SOURCE_RATE,
    get_bool,
    get_int,
    get_long,
    sink_options,
    source_options,
    with_prefix,
)

SOURCE = {"root": "/r", "source.project": "p", "source.topic": "t", "source.subId": "s"}
SINK = {"root": "/r", "sink.project": "p", "sink.topic": "t"}


def test_defaults():
    source, sink = source_options(SOURCE), sink_options(SINK)
    assert source.rate == DEFAULT_SOURCE_RATE == 50000
    assert sink.batch_enable is True
    assert sink.producer == "main"


def test_default_project_fills_both_sides_and_is_overridden():
    props = {**SOURCE, **SINK, "default.project": "shared", "sink.project": " "}
    assert source_options(props).project == "p"
    assert sink_options(props).project == "shared"
    del props["source.project"]
    assert source_options(props).project == "shared"


@pytest.mark.parametrize("key", list(SOURCE))
@pytest.mark.parametrize("value", [None, "", "  "])
def test_missing_source_option(key, value):
    props = {k: v for k, v in SOURCE.items() if k != key} | ({} if value is None else {key: value})
    with pytest.raises(ValueError, match=key):
        source_options(props)


@pytest.mark.parametrize("key", list(SINK))
@pytest.mark.parametrize("value", [None, "", "  "])
def test_missing_sink_option(key, value):
    props = {k: v for k, v in SINK.items() if k != key} | ({} if value is None else {key: value})
    with pytest.raises(ValueError, match=key):
        sink_options(props)


@pytest.mark.parametrize("text", ["x", "1.5", "1_000", "0x10", "2147483648", "1 000", "٣"])
def test_bad_integers(text):
    with pytest.raises(ValueError):
        get_int({"k": text}, "k", 1)


def test_integers():
    assert get_int({"k": "-7"}, "k", 1) == -7
    assert get_int({}, "k", 1) == 1
    assert get_long({"k": "2147483648"}, "k", 1) == 2147483648
    with pytest.raises(ValueError):
        get_long({"k": str(1 << 63)}, "k", 1)
    with pytest.raises(ValueError, match="positive"):
        source_options({**SOURCE, "source.rate": "0"})


@pytest.mark.parametrize(
    ("text", "value"), [("true", True), ("TRUE", True), ("yes", False), ("1", False), ("false", False)]
)
def test_booleans(text, value):
    assert get_bool({"k": text}, "k", not value) is value


def test_sink_rate_is_off_unless_set():
    assert sink_options(SINK).rate is None
    assert sink_options({**SINK, "sink.rate": "2000"}).rate == 2000
    with pytest.raises(ValueError, match="sink.rate"):
        sink_options({**SINK, "sink.rate": "-1"})


def test_prefix():
    assert with_prefix("source.", {"source.topic": "t", "sink.topic": "u"}) == {"topic": "t"}
