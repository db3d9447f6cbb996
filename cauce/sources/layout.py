"""Dataset addressing (S8): where inputs are read and outputs written.

Roots are URI strings (local path, ``hdfs://``, ``s3a://`` ...). Precedence for the input
root: argument, ``DATA_IN_DIR``, ``DATA_DIR``, ``data``; for the output root: argument,
``DATA_OUT_DIR``, ``<DATA_DIR>/output``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _absolute(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else os.path.abspath(path)


@dataclass(frozen=True)
class Layout:
    in_root: str
    out_root: str
    # Input and output file names expected by users of the original jobs.
    renta_csv: str = "renta_por_hogar.csv"
    delitos_csv: str = "delitos_por_municipio.csv"
    contact_csv: str = "contac_center_data.csv"
    final_name: str = "integration.csv"

    @classmethod
    def resolve(
        cls, in_root: str | None = None, out_root: str | None = None, data_dir: str | None = None
    ) -> "Layout":
        base = data_dir or os.getenv("DATA_DIR") or "data"
        src = in_root or os.getenv("DATA_IN_DIR") or base
        dst = out_root or os.getenv("DATA_OUT_DIR") or _join(base, "output")
        return cls(_absolute(src), _absolute(dst))

    # inputs
    def csv(self, source: str) -> str:
        name = {"renta": self.renta_csv, "delitos": self.delitos_csv, "contact": self.contact_csv}[source]
        return _join(self.in_root, name)

    # outputs (fixed naming: <source>_RAW.parquet, <source>_CLEAN.parquet)
    def raw(self, source: str) -> str:
        return _join(self.out_root, "raw", f"{source}_RAW.parquet")

    def clean(self, source: str) -> str:
        return _join(self.out_root, "clean", f"{source}_CLEAN.parquet")

    def final(self) -> str:
        return _join(self.out_root, "final", self.final_name)


SOURCES = ("renta", "delitos", "contact")
