"""A run's configuration as YAML: one line for each key, values in JSON, which is YAML too, so that no library is needed to write it or to read it back."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from coverloom import __version__


def dump(config: dict) -> str:
    """The configuration's text; keys without a value are left out, and the version comes first."""
    lines = {"version": __version__} | {k: v for k, v in config.items() if v is not None}
    return "".join(f"{k}: {json.dumps(v)}\n" for k, v in lines.items())


def parse(text: str) -> dict:
    """The keys and values of a text that dump has made, or of other YAML if a library for it is there."""
    out = {}
    try:
        for line in text.splitlines():
            if line.strip() and not line.startswith("#"):
                key, colon, value = line.partition(":")
                if not colon:
                    raise ValueError(line)
                out[key.strip()] = json.loads(value) if value.strip() else None
        return out
    except ValueError:
        try:
            import yaml
        except ImportError:
            raise ValueError("this configuration has more than one line for a key, which needs a YAML library") from None
        return yaml.safe_load(text) or {}


def merged(base: dict, *changes: dict) -> dict:
    """Later values over earlier ones; None changes nothing."""
    out = dict(base)
    for c in changes:
        out |= {k: v for k, v in c.items() if v is not None}
    return out


def write(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file, in any file system that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read(spark: SparkSession, path: str) -> str:
    return "".join(r["value"] + "\n" for r in spark.read.text(path, wholetext=False).coalesce(1).collect())
