"""Where landed files and tables lie under one root URI."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def raw(self, subject: str) -> str:
        return f"{self.root}/raw/{subject}"

    @property
    def holidays(self) -> str:
        return f"{self.root}/raw/holidays"

    @property
    def ticks(self) -> str:
        return f"{self.root}/ticks"

    @property
    def bars(self) -> str:
        return f"{self.root}/bars"

    @property
    def manifest(self) -> str:
        return f"{self.root}/landed_files"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"

    def zones(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}_zones"
