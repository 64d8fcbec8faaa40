"""Validated load options."""

from __future__ import annotations

from dataclasses import dataclass, replace

from ..errors import InvalidArgument

# Modes, text policies, inline limits of a database in bytes.
MODES = ("create", "append", "replace", "create_append")
STRING_TYPES = ("auto", "varchar2", "clob")
STANDARD_LIMIT = 4000
EXTENDED_LIMIT = 32767
OPTION_NAMES = (
    "string_type", "clob_columns", "type_scan_limit_bytes", "max_string_size", "ingest_workers", "ingest_file_bytes",
)


def check_mode(mode: str) -> str:
    """The mode's plain name; a dotted prefix is allowed, as for options."""
    name = (mode or "create").lower().rsplit(".", 1)[-1]
    if name not in MODES:
        raise InvalidArgument(f"unknown ingest mode: {mode!r} (one of {', '.join(MODES)})")
    return name


@dataclass(frozen=True)
class LoadOptions:
    """How text columns are declared and how wide the write fans out.

    ``type_scan_limit_bytes`` unset means every row is looked at, 0 that none is. Any other
    limit is refused: a later value could be wider than what the first ones show.
    ``max_string_size`` is ``standard``, ``extended`` or a number of bytes; unknown (None)
    counts as standard. ``ingest_workers`` is the number of writing tasks; with ``ingest_file_bytes``, which
    chooses it from the bytes there are, it is the greatest number.
    """

    string_type: str = "auto"
    clob_columns: tuple[str, ...] = ()
    type_scan_limit_bytes: int | None = None
    max_string_size: str | int | None = "standard"
    ingest_workers: int | None = None
    ingest_file_bytes: int | None = None

    def __post_init__(self):
        text_type = (self.string_type or "auto").strip().lower()
        if text_type not in STRING_TYPES:
            raise InvalidArgument(f"string_type must be one of {STRING_TYPES}, got {self.string_type!r}")
        names = self.clob_columns
        names = names.split(",") if isinstance(names, str) else names
        names = tuple(sorted({name.strip().upper() for name in names if name.strip()}))
        object.__setattr__(self, "string_type", text_type)
        object.__setattr__(self, "clob_columns", names)
        object.__setattr__(self, "type_scan_limit_bytes", _count("type_scan_limit_bytes", self.type_scan_limit_bytes))
        if self.type_scan_limit_bytes:
            raise InvalidArgument("type_scan_limit_bytes must be 0 or unset: column types are chosen from all rows")
        object.__setattr__(self, "ingest_workers", _count("ingest_workers", self.ingest_workers))
        object.__setattr__(self, "ingest_file_bytes", _count("ingest_file_bytes", self.ingest_file_bytes))
        self.inline_limit  # fails on a size that is not understood

    @property
    def inline_limit(self) -> int:
        size = self.max_string_size
        if isinstance(size, int):
            return size
        known = {None: STANDARD_LIMIT, "standard": STANDARD_LIMIT, "extended": EXTENDED_LIMIT}
        try:
            return known[size.lower() if size else None]
        except KeyError:
            raise InvalidArgument(f"max_string_size must be standard or extended, got {size!r}") from None

    @classmethod
    def parse(cls, options: "LoadOptions | dict | None") -> "LoadOptions":
        """From a mapping of option names; a dotted prefix is allowed, unknown names are not."""
        if isinstance(options, cls):
            return options
        result = cls()
        for key, value in (options or {}).items():
            name = key.rsplit(".", 1)[-1].lower()
            if name not in OPTION_NAMES:
                raise InvalidArgument(f"unknown option: {key}")
            result = replace(result, **{name: value})
        return result


def _count(name: str, value) -> int | None:
    if value is None:
        return None
    try:
        number = int(value)
    except (TypeError, ValueError):
        number = -1
    if number < 0:
        raise InvalidArgument(f"{name} must be a non-negative integer, got {value!r}")
    return number
