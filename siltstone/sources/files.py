"""Which files a table consists of, by any file system that Spark reaches."""

from __future__ import annotations

import hashlib
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

from siltstone.errors import CatalogError, OptionError
from siltstone.sources.options import TableOptions

S3_SCHEMES = ("s3", "s3a", "s3n")


class Store:
    """The Hadoop file system calls that the engine needs."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(spark_path(name))

    def fs(self, name: str):
        return self.path(name).getFileSystem(self.conf)

    def exists(self, name: str) -> bool:
        return self.fs(name).exists(self.path(name))

    def is_file(self, name: str) -> bool:
        return self.exists(name) and self.fs(name).getFileStatus(self.path(name)).isFile()

    def list_files(self, name: str, recursive: bool = True) -> list[str]:
        """Files below a folder in the order of their paths; hidden ones and those below hidden folders are left out."""
        if not self.exists(name):
            raise CatalogError(f"no such file or directory: {name}")
        found, files = [], self.fs(name).listFiles(self.path(name), recursive)
        root = self.path(name).toUri().getPath().rstrip("/")
        while files.hasNext():
            path = files.next().getPath()
            inner = path.toUri().getPath()[len(root) :].strip("/").split("/")
            if not any(part.startswith((".", "_")) for part in inner):
                found.append(path.toString().removeprefix("file:") if "://" not in path.toString() else path.toString())
        return sorted(found)

    def delete(self, name: str, recursive: bool = False) -> bool:
        return self.fs(name).delete(self.path(name), recursive)

    def rename(self, source: str, target: str) -> None:
        if not self.fs(target).rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Put source in the place of target, which may exist, in one step of the file system: until then target is the
        old file and after it the new one."""
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        how[0] = options.OVERWRITE
        target_path = self.path(target)
        whole = self.fs(target).makeQualified(target_path)
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), self.conf).rename(self.path(source), whole, how)

    def missing(self, names: list[str]) -> str | None:
        """The first of names that doesn't exist; folders that hold several of them are listed once."""
        folders: dict[str, list[str]] = {}
        for name in names:
            folders.setdefault(name.rpartition("/")[0], []).append(name)
        gone = set()
        for folder, own in folders.items():
            if len(own) < 8 or not folder or not self.exists(folder):
                gone |= {n for n in own if not self.exists(n)}
            else:
                there = {f.getPath().getName() for f in self.fs(folder).listStatus(self.path(folder))}
                gone |= {n for n in own if n.rpartition("/")[2] not in there}
        return next((n for n in names if n in gone), None)

    def fingerprint(self, names: list[str]) -> str:
        """Changes with the names, lengths and times of files."""
        found = [self.fs(n).getFileStatus(self.path(n)) for n in names]
        told = "\n".join(f"{n} {s.getLen()} {s.getModificationTime()}" for n, s in zip(names, found, strict=True))
        return hashlib.md5(told.encode()).hexdigest()

    def write_bytes(self, name: str, data: bytes) -> None:
        """A small file."""
        out = self.fs(name).create(self.path(name), True)
        out.write(bytearray(data))
        out.close()

    def make_folder(self, name: str) -> None:
        self.fs(name).mkdirs(self.path(name))


def spark_path(name: str) -> str:
    """s3:// as Spark's client calls it; all else as it is."""
    return "s3a://" + name[len("s3://") :] if name.startswith("s3://") else name


def is_s3(name: str) -> bool:
    return urlsplit(name).scheme in S3_SCHEMES


def split_s3(name: str) -> tuple[str, str]:
    """(bucket, key) of an object's path."""
    parts = urlsplit(name)
    if parts.scheme not in S3_SCHEMES or not parts.netloc:
        raise OptionError(f"not an S3 path: {name}")
    return parts.netloc, parts.path.lstrip("/")


def check_one_kind(names: list[str]) -> None:
    if len({is_s3(n) for n in names}) > 1:
        raise OptionError("local and S3 paths can't be mixed in one table")


def table_files(spark: SparkSession, options: TableOptions, check: bool = True) -> list[str]:
    """A table's files, found anew at each call: a list, a folder's files, or what a function returns."""
    if options.files_func is not None:
        names = list(options.files_func(options.files_func_arg) or [])
        if not all(isinstance(n, str) for n in names):
            raise OptionError("files_func must return paths")
    elif options.dirname is not None:
        return Store(spark).list_files(options.dirname)
    else:
        names = list(options.filename)
    check_one_kind(names)
    if check:
        gone = Store(spark).missing([n for n in names if not is_s3(n)])
        if gone is not None:
            raise CatalogError(f"no such file or directory: {gone}")
    return names
