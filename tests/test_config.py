from datetime import timedelta

import pytest

from syncspark.config import CommentMode, ReadMode, SyncConfig, parse_duration
from syncspark.errors import ConfigError


def base(**changes):
    return SyncConfig(**{"source": "s", "document_id": "id", "updated": "u", "fields": {"a": "b"}, **changes})


def test_defaults():
    cfg = base(field_source=" ", field_space_key=" space ")
    assert (cfg.field_source, cfg.field_space_key, cfg.field_document_id) == ("source", "space", "document_id")
    assert cfg.comment_mode is CommentMode.NONE and cfg.read_mode is ReadMode.UPDATE_TIMESTAMP
    assert cfg.doc_types == ["document"]


@pytest.mark.parametrize(
    "changes",
    [
        {"document_id": " "},
        {"updated": None},
        {"deleted": "d"},
        {"deleted_value": "true"},
        {"fields": None},
        {"fields": {"a": {"remote_field": ""}}},
        {"fields": {" ": "b"}},
        {"fields": {"a": {"remote_field": "b", "value_filter": "nope"}}},
        {"comment_mode": "embedded"},
        {"comment_mode": "embedded", "comments": "c", "field_comments": "cs"},
        {"comment_mode": "child", "comments": "c", "field_comments": "cs", "comment_fields": {"x": "y"}},
        {"comment_mode": "child", "comments": "c", "field_comments": "cs", "comment_fields": {"x": "y"}, "comment_type": "t"},
        {"comment_mode": "what"},
        {"read_mode": "what"},
    ],
)
def test_invalid(changes):
    with pytest.raises(ConfigError):
        base(**changes)


def test_update_field_only_needed_for_update_times():
    assert base(updated=None, read_mode="SIMPLE").read_mode is ReadMode.SIMPLE
    assert not base(updated=None, read_mode="pagination").read_mode.incremental


def test_modes_ignore_case():
    assert CommentMode.parse(" Child ") is CommentMode.CHILD
    assert CommentMode.parse("") is CommentMode.NONE
    assert ReadMode.parse("UPDATETIMESTAMP") is ReadMode.UPDATE_TIMESTAMP
    assert ReadMode.parse(" ") is None


def test_durations():
    given = {"250": 0.25, "255ms": 0.255, "250s": 250, "50m": 3000, "2h": 7200, "2d": 172800, "2w": 1209600, "0": 0, "-1": -0.001}
    for text, seconds in given.items():
        assert parse_duration(text) == timedelta(seconds=seconds)
    assert parse_duration(None, timedelta(1)) == timedelta(1)
    for bad in ("w", "xs"):
        with pytest.raises(ConfigError):
            parse_duration(bad)
    assert SyncConfig.from_dict({"source": "s", "document_id": "i", "updated": "u", "fields": {}, "update_period": "2m"}).update_period == timedelta(minutes=2)
