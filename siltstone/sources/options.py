"""Options of servers, tables and columns: parsing and validation."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from siltstone.errors import OptionError

#: Fixed names of the options and of the codecs.
SERVER_OPTIONS = {"use_minio", "keep_connections", "region", "endpoint"}
USER_OPTIONS = {"user", "password"}
TABLE_OPTIONS = {
    "filename", "dirname", "files_func", "files_func_arg", "sorted", "files_in_order", "use_mmap", "use_threads",
    "max_open_files", "schemaless", "key_columns", "insert_file_selector", "compression_type",
}
COLUMN_OPTIONS = {"key", "column_name", "compression_type"}
CODECS = {"uncompressed": "uncompressed", "snappy": "snappy", "zstd": "zstd"}
LONGEST_NAME = 63


def parse_bool(value: object, option: str = "option") -> bool:
    """true/on/1 and false/off/0 in any case; nothing else."""
    if isinstance(value, bool):
        return value
    text = str(value).lower()
    if text in ("true", "on", "1"):
        return True
    if text in ("false", "off", "0"):
        return False
    raise OptionError(f"invalid value for boolean option {option!r}: {value}")


def parse_list(text: str, option: str = "option") -> list[str]:
    """Items between white space. Double quotes hold white space together; two of them inside stand for one."""
    items, at, n = [], 0, len(text)
    while at < n:
        if text[at].isspace():
            at += 1
            continue
        item = ""
        if text[at] == '"':
            at += 1
            while True:
                end = text.find('"', at)
                if end < 0:
                    raise OptionError(f"option {option!r}: unterminated double quote in {text!r}")
                item += text[at:end]
                at = end + 1
                if not text.startswith('"', at):
                    break
                item += '"'
                at += 1
            if at < n and not text[at].isspace():
                raise OptionError(f"option {option!r}: white space expected after a quoted item in {text!r}")
        else:
            end = at
            while end < n and not text[end].isspace():
                end += 1
            item, at = text[at:end], end
            if '"' in item:
                raise OptionError(f"option {option!r}: misplaced double quote in {text!r}")
        items.append(item)
    return items


def codec(value: str) -> str:
    name = CODECS.get(str(value).lower())
    if name is None:
        raise OptionError(f"compression type {value!r} is not supported")
    return name


@dataclass
class ServerConfig:
    """An object store behind tables, and how Spark's S3A client reaches it."""

    name: str
    use_minio: bool = False
    keep_connections: bool = True
    region: str = "ap-northeast-1"
    endpoint: str = "127.0.0.1:9000"
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    valid: bool = True

    @classmethod
    def from_options(cls, name: str, options: dict[str, object]) -> ServerConfig:
        unknown = set(options) - SERVER_OPTIONS
        if unknown:
            raise OptionError(f"option {sorted(unknown)[0]!r} not found")
        values = {k: parse_bool(v, k) if k in ("use_minio", "keep_connections") else str(v) for k, v in options.items()}
        return cls(name, **values)

    def map_user(self, options: dict[str, str]) -> None:
        unknown = set(options) - USER_OPTIONS
        if unknown:
            raise OptionError(f"option {sorted(unknown)[0]!r} not found")
        if any(not v for v in options.values()):
            raise OptionError("user and password must not be empty")
        self.user, self.password = options.get("user", self.user), options.get("password", self.password)

    def hadoop_conf(self, bucket: str) -> dict[str, str]:
        """Settings of the S3A file system for one bucket."""
        own = f"fs.s3a.bucket.{bucket}."
        conf = {own + "endpoint.region": self.region, own + "connection.ssl.enabled": str(not self.use_minio).lower()}
        if self.use_minio:
            conf |= {own + "endpoint": f"http://{self.endpoint}", own + "path.style.access": "true"}
        if self.user is not None and self.password is not None:
            conf |= {own + "access.key": self.user, own + "secret.key": self.password}
        return conf


@dataclass
class TableOptions:
    """A table's options, checked."""

    filename: list[str] = field(default_factory=list)
    dirname: str | None = None
    files_func: Callable[..., Iterable[str]] | None = None
    files_func_arg: object = None
    sorted: list[str] = field(default_factory=list)
    files_in_order: bool = False
    use_mmap: bool = False
    use_threads: bool = False
    max_open_files: int = 0
    schemaless: bool = False
    key_columns: list[str] = field(default_factory=list)
    insert_file_selector: object = None
    compression_type: str | None = None

    @classmethod
    def parse(cls, options: dict[str, object]) -> TableOptions:
        values: dict[str, object] = {}
        for name, value in options.items():
            if name in SERVER_OPTIONS:
                continue  # accepted on tables too, where they change nothing
            if name not in TABLE_OPTIONS:
                raise OptionError(f"invalid option {name!r}")
            if name in ("filename", "sorted", "key_columns"):
                value = parse_list(value, name) if isinstance(value, str) else list(value)
            elif name in ("files_in_order", "use_mmap", "use_threads", "schemaless"):
                value = parse_bool(value, name)
            elif name == "max_open_files":
                if not str(value).lstrip("-").isdigit() or int(str(value)) < 0:
                    raise OptionError(f"invalid value for option {name!r}: {value}")
                value = int(str(value))
            elif name == "compression_type":
                value = codec(str(value))
            elif name == "files_func" and not callable(value):
                raise OptionError("option 'files_func' must be a function")
            values[name] = value
        parsed = cls(**values)
        if parsed.filename and parsed.dirname:
            raise OptionError("options 'filename' and 'dirname' exclude each other")
        if not parsed.filename and not parsed.dirname and parsed.files_func is None:
            raise OptionError("one of the options 'filename', 'dirname' and 'files_func' is required")
        return parsed


@dataclass
class ColumnOptions:
    key: bool = False
    column_name: str | None = None
    compression_type: str | None = None

    @classmethod
    def parse(cls, options: dict[str, object]) -> ColumnOptions:
        unknown = set(options) - COLUMN_OPTIONS
        if unknown:
            raise OptionError(f"invalid option {sorted(unknown)[0]!r}")
        values = dict(options)
        if "key" in values:
            values["key"] = parse_bool(values["key"], "key")
        if "compression_type" in values:
            values["compression_type"] = codec(str(values["compression_type"]))
        return cls(**values)
