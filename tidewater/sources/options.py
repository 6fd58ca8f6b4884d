"""Options of the topic log's source and sink: names, defaults, rules and the words they fail with."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tidewater.operators.offsets import from_json, times_from_json

URL = "service.url"
TOPICS = ("topic", "topics", "topicspattern")
START, END, START_TIME, END_TIME = "startingoffsets", "endingoffsets", "startingtime", "endingtime"
EARLIEST, LATEST = "earliest", "latest"
#: Prefixes of options passed on, and the keys each may have.
PASSED = {
    "client": {"authparams", "authplugin", "iothreads", "timeoutms"},
    "admin": {"authparams", "authplugin", "url", "timeoutms"},
    "reader": {"batchrows"},
    "producer": {"batchsize", "compression", "entriesperledger"},
}
SECRET = {"authparams"}

Bound = str | dict[str, tuple[int, int, int]] | dict[str, int] | int


@dataclass(frozen=True)
class Where:
    """A bound of a read: 'earliest', 'latest', positions by topic-partition, a time for all, or times by topic-partition."""

    kind: str
    value: object = None


@dataclass(frozen=True)
class ReadOptions:
    url: str
    topic_option: tuple[str, str]
    start: Where
    end: Where
    fail_on_data_loss: bool = False
    max_bytes: int = 0
    poll_timeout_ms: int = 120_000
    allow_different_schemas: bool = False
    wait_for_topic: bool = False
    subscription: str | None = None
    predefined: bool = False
    passed: dict[str, dict[str, str]] = field(default_factory=dict)


def lowered(options: Mapping[str, str]) -> dict[str, str]:
    return {k.lower(): v for k, v in options.items()}


def passed_on(options: Mapping[str, str]) -> dict[str, dict[str, str]]:
    """Options with a prefix, without it; raises on keys that nothing knows."""
    out: dict[str, dict[str, str]] = {k: {} for k in PASSED}
    for name, value in lowered(options).items():
        prefix, dot, key = name.partition(".")
        if dot and prefix in PASSED and name != "admin.url":
            if key not in PASSED[prefix]:
                raise ValueError(f"{name} is no option of the topic log")
            out[prefix][key] = value
    return out


def masked(options: Mapping[str, str]) -> dict[str, str]:
    """Options fit for a log: of secrets of six characters or more the first third, of shorter ones nothing."""
    out = {}
    for name, value in options.items():
        secret = name.lower().rpartition(".")[2] in SECRET
        out[name] = value if not secret else "..." if len(value) < 6 else value[: len(value) // 3] + "..."
    return out


def bound(options: Mapping[str, str], offsets_key: str, time_key: str, default: str) -> Where:
    given, time = options.get(offsets_key), options.get(time_key)
    if given is not None and time is not None:
        raise ValueError(f"{offsets_key} and {time_key} exclude each other")
    if given is not None:
        given = given.strip()
        return Where(given.lower()) if given.lower() in (EARLIEST, LATEST) else Where("positions", from_json(given))
    if time is None:
        return Where(default)
    time = time.strip()
    if time.startswith("{"):
        return Where("times", times_from_json(time))
    try:
        return Where("time", int(time))
    except ValueError as e:
        raise ValueError(f"{time_key} is no whole number of milliseconds: {time}") from e


def _flag(options: Mapping[str, str], name: str, default: bool = False) -> bool:
    return options.get(name, str(default)).strip().lower() == "true"


def _topic_option(options: Mapping[str, str]) -> tuple[str, str]:
    given = [(k, options[k]) for k in TOPICS if k in options]
    if len(given) != 1:
        raise ValueError(f"exactly one of {', '.join(TOPICS)} has to be given")
    key, value = given[0]
    if key == "topic" and "," in value:
        raise ValueError("topic names one topic; topics takes a list")
    if key == "topic" and not value.strip():
        raise ValueError("topic is empty")
    if key == "topics" and not [t for t in value.split(",") if t.strip()]:
        raise ValueError(f"the list of topics is empty: {value!r}")
    if key == "topicspattern" and not value.strip():
        raise ValueError("topicspattern is empty")
    return key, value


def read_options(options: Mapping[str, str], streaming: bool) -> ReadOptions:
    o = lowered(options)
    if streaming and END in o:
        raise ValueError("a stream has no end; endingoffsets is for batch reads")
    start, end = bound(o, START, START_TIME, LATEST if streaming else EARLIEST), bound(o, END, END_TIME, LATEST)
    if not streaming:
        if start.kind == LATEST:
            raise ValueError("a batch read can't start at latest")
        if end.kind == EARLIEST:
            raise ValueError("a batch read can't end at earliest")
    if URL not in o:
        raise ValueError(f"{URL} is missing")
    topic = _topic_option(o)
    max_bytes = int(o.get("maxbytespertrigger", "0"))
    if max_bytes and "admin.url" not in o:
        raise ValueError("maxbytespertrigger needs admin.url")
    named = o.get("predefinedsubscription")
    return ReadOptions(
        o[URL], topic, start, end, _flag(o, "failondataloss"), max_bytes, int(o.get("polltimeoutms", "120000")),
        _flag(o, "allowdifferenttopicschemas"), _flag(o, "waitingfornonexistedtopic"), named or o.get("subscriptionprefix"), named is not None, passed_on(o),
    )


def sink_options(options: Mapping[str, str]) -> tuple[str, str | None, dict[str, dict[str, str]]]:
    """The log's place, the topic if one is given, and options passed on."""
    o = lowered(options)
    if URL not in o:
        raise ValueError(f"{URL} is missing")
    if "topics" in o or "topicspattern" in o:
        raise ValueError("a sink takes topic, not topics or topicspattern")
    topic = o.get("topic")
    if topic is not None and not topic.strip():
        raise ValueError("topic is empty")
    return o[URL], topic, passed_on(o)
