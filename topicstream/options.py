"""Job options: keys, defaults, and the checks made before any plan is built.

Options are a flat mapping of text, as a properties file or ``spark-submit`` arguments give them.
A blank value counts as missing everywhere.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

# Option keys.
ROOT = "root"
DEFAULT_PROJECT = "default.project"
SOURCE_PROJECT = "source.project"
SOURCE_TOPIC = "source.topic"
SOURCE_SUBSCRIPTION = "source.subId"
SOURCE_RATE = "source.rate"
SINK_PROJECT = "sink.project"
SINK_TOPIC = "sink.topic"
SINK_PRODUCER = "sink.producer"
SINK_BATCH_ENABLE = "sink.batchEnable"
SINK_RATE = "sink.rate"

# Defaults of the options.
DEFAULT_SOURCE_RATE = 50000
DEFAULT_BATCH_ENABLE = True
# Fixed value: time between two commits of a batching sink, in seconds.
COMMIT_INTERVAL_SECONDS = 180

DEFAULT_PRODUCER = "main"

_INTEGER = re.compile(r"[+-]?[0-9]+")


@dataclass(frozen=True)
class SourceOptions:
    root: str
    project: str
    topic: str
    subscription: str
    rate: int


@dataclass(frozen=True)
class SinkOptions:
    root: str
    project: str
    topic: str
    producer: str
    batch_enable: bool
    rate: int | None


def source_options(props: Mapping[str, str]) -> SourceOptions:
    """Resolve and check the read side. Raises ``ValueError`` for a missing option."""
    return SourceOptions(
        root=required(props, ROOT),
        project=_project(props, SOURCE_PROJECT),
        topic=required(props, SOURCE_TOPIC),
        subscription=required(props, SOURCE_SUBSCRIPTION),
        rate=_rate(props, SOURCE_RATE, DEFAULT_SOURCE_RATE),
    )


def sink_options(props: Mapping[str, str]) -> SinkOptions:
    """Resolve and check the write side. Raises ``ValueError`` for a missing option."""
    return SinkOptions(
        root=required(props, ROOT),
        project=_project(props, SINK_PROJECT),
        topic=required(props, SINK_TOPIC),
        producer=_value(props, SINK_PRODUCER) or DEFAULT_PRODUCER,
        batch_enable=get_bool(props, SINK_BATCH_ENABLE, DEFAULT_BATCH_ENABLE),
        # No limit of its own unless one is asked for.
        rate=_rate(props, SINK_RATE, 1) if _value(props, SINK_RATE) else None,
    )


def required(props: Mapping[str, str], key: str) -> str:
    value = _value(props, key)
    if value is None:
        raise ValueError(f"option {key} is missing")
    return value


def get_int(props: Mapping[str, str], key: str, default: int) -> int:
    """32-bit integer option; bad text raises."""
    return _integer(props, key, default, 32)


def get_long(props: Mapping[str, str], key: str, default: int) -> int:
    """64-bit integer option; bad text raises."""
    return _integer(props, key, default, 64)


def get_bool(props: Mapping[str, str], key: str, default: bool) -> bool:
    """True only for the text ``true`` in any case."""
    value = _value(props, key)
    return default if value is None else value.lower() == "true"


def with_prefix(prefix: str, props: Mapping[str, str]) -> dict[str, str]:
    """The options whose key starts with ``prefix``, with the prefix removed."""
    return {k[len(prefix) :]: v for k, v in props.items() if k.startswith(prefix)}


def _project(props: Mapping[str, str], key: str) -> str:
    value = _value(props, key) or _value(props, DEFAULT_PROJECT)
    if value is None:
        raise ValueError(f"option {key} is missing, and so is {DEFAULT_PROJECT}")
    return value


def _rate(props: Mapping[str, str], key: str, default: int) -> int:
    rate = get_int(props, key, default)
    if rate < 1:
        raise ValueError(f"option {key} must be positive, got {rate}")
    return rate


def _integer(props: Mapping[str, str], key: str, default: int, bits: int) -> int:
    value = _value(props, key)
    if value is None:
        return default
    if not _INTEGER.fullmatch(value):
        raise ValueError(f"option {key} is not an integer: {value!r}")
    number = int(value)
    if not -(1 << (bits - 1)) <= number < 1 << (bits - 1):
        raise ValueError(f"option {key} does not fit {bits} bits: {value}")
    return number


def _value(props: Mapping[str, str], key: str) -> str | None:
    value = props.get(key)
    if value is None or not str(value).strip():
        return None
    return str(value).strip()
