"""Typed configuration of one synchronised source."""

from __future__ import annotations

import enum
import re
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from syncspark.errors import ConfigError


def blank(text: object) -> bool:
    return text is None or not str(text).strip()


class ReadMode(enum.Enum):
    SIMPLE = "simple"
    PAGINATION = "pagination"
    UPDATE_TIMESTAMP = "updateTimestamp"

    @property
    def incremental(self) -> bool:
        return self is ReadMode.UPDATE_TIMESTAMP

    @classmethod
    def parse(cls, text: str | None) -> "ReadMode | None":
        return _parse_enum(cls, text, "read mode", None)


class CommentMode(enum.Enum):
    NONE = "none"
    EMBEDDED = "embedded"
    CHILD = "child"
    STANDALONE = "standalone"

    @property
    def separate_rows(self) -> bool:
        return self in (CommentMode.CHILD, CommentMode.STANDALONE)

    @classmethod
    def parse(cls, text: str | None) -> "CommentMode":
        return _parse_enum(cls, text, "comment mode", cls.NONE)


def _parse_enum(kind, text, what, default):
    if blank(text):
        return default
    for member in kind:
        if member.value.lower() == str(text).strip().lower():
            return member
    raise ConfigError(f"unsupported value for {what}: {text}")


_UNITS = {"": 1, "ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}


def parse_duration(text: object, default: timedelta | None = None) -> timedelta | None:
    """``5m``, ``2w`` or plain milliseconds."""
    if blank(text):
        return default
    match = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)(ms|[smhdw]?)\s*", str(text))
    if match is None:
        raise ConfigError(f"not a time value: {text}")
    return timedelta(milliseconds=float(match[1]) * _UNITS[match[2]])


@dataclass(frozen=True)
class FieldMapping:
    remote_field: str
    value_filter: str | None = None


def _fields(mapping) -> dict[str, FieldMapping]:
    out = {}
    for name, entry in (mapping or {}).items():
        if isinstance(entry, FieldMapping):
            out[name] = entry
        elif isinstance(entry, str):
            out[name] = FieldMapping(entry)
        else:
            out[name] = FieldMapping(entry.get("remote_field") or "", entry.get("value_filter"))
    return out


@dataclass
class SyncConfig:
    """What to read, how to reshape it and where it is keyed."""

    source: str
    document_id: str
    fields: dict
    updated: str | None = None
    updated_format: str | None = None
    deleted: str | None = None
    deleted_value: str | None = None
    value_filters: dict[str, dict[str, str]] = field(default_factory=dict)
    comment_mode: CommentMode | str | None = None
    comments: str | None = None
    comment_id: str | None = None
    comment_fields: dict | None = None
    field_comments: str | None = None
    doc_type: str = "document"
    comment_type: str | None = None
    field_source: str | None = "source"
    field_space_key: str | None = "space_key"
    field_document_id: str | None = "document_id"
    read_mode: ReadMode | str | None = None
    spaces_indexed: str | None = None
    spaces_excluded: str | None = None
    update_period: timedelta = timedelta(minutes=5)
    full_update_period: timedelta = timedelta(hours=12)
    slice_span: timedelta | None = None  # update times are asked for in stretches of this length
    first_update: datetime | None = None  # where slices begin when nothing is stored yet

    def __post_init__(self):
        if not isinstance(self.comment_mode, CommentMode):
            self.comment_mode = CommentMode.parse(self.comment_mode)
        if not isinstance(self.read_mode, ReadMode):
            self.read_mode = ReadMode.parse(self.read_mode) or ReadMode.UPDATE_TIMESTAMP
        self.field_source = "source" if blank(self.field_source) else self.field_source.strip()
        self.field_space_key = "space_key" if blank(self.field_space_key) else self.field_space_key.strip()
        self.field_document_id = "document_id" if blank(self.field_document_id) else self.field_document_id.strip()
        self.value_filters = self.value_filters or {}
        self.validate()
        self.fields = _fields(self.fields)
        self.comment_fields = _fields(self.comment_fields)

    @property
    def doc_types(self) -> list[str]:
        """Row types this source owns in the target."""
        if self.comment_mode.separate_rows:
            return [self.doc_type, self.comment_type]
        return [self.doc_type]

    def first_names(self) -> list[str]:
        """First steps of all paths into a document, in order of use."""
        paths = [self.document_id, self.updated, self.deleted, self.comments]
        paths += [mapping.remote_field for mapping in self.fields.values()]
        return list(dict.fromkeys(path.split(".")[0] for path in paths if path))

    def validate(self) -> None:
        self._text(self.document_id, "document_id")
        if self.read_mode is ReadMode.UPDATE_TIMESTAMP:
            self._text(self.updated, "updated")
        if blank(self.deleted) != blank(self.deleted_value):
            raise ConfigError("'deleted' and 'deleted_value' must be both set or both empty")
        if self.fields is None:
            raise ConfigError("'fields' must be given")
        if self.comment_mode is not CommentMode.NONE:
            self._text(self.comments, "comments")
            self._text(self.field_comments, "field_comments")
            if self.comment_fields is None:
                raise ConfigError("'comment_fields' must be given")
            self._mappings(self.comment_fields, "comment_fields")
            if self.comment_mode.separate_rows:
                self._text(self.comment_type, "comment_type")
                self._text(self.comment_id, "comment_id")
        self._mappings(self.fields, "fields")

    @staticmethod
    def _text(value, name) -> None:
        if blank(value):
            raise ConfigError(f"a value must be given for '{name}'")

    def _mappings(self, mappings, section) -> None:
        if any(blank(name) for name in mappings):
            raise ConfigError(f"empty key in '{section}'")
        for name, mapping in _fields(mappings).items():
            if blank(mapping.remote_field):
                raise ConfigError(f"'remote_field' is not defined in '{section}/{name}'")
            if mapping.value_filter is not None and mapping.value_filter not in self.value_filters:
                raise ConfigError(f"filter '{mapping.value_filter}' of '{section}/{name}' is not defined")

    @classmethod
    def from_dict(cls, settings: dict) -> "SyncConfig":
        settings = dict(settings)
        for name in ("update_period", "full_update_period", "slice_span"):
            if name in settings and not isinstance(settings[name], timedelta):
                settings[name] = parse_duration(settings[name], cls.__dataclass_fields__[name].default)
        return cls(**settings)
