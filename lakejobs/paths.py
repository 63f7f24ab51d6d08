"""Where the layers of a lake live."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "gold", "quarantine")


@dataclass(frozen=True)
class LakePaths:
    """Directory names of layers and tables below one root."""

    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def bronze(self, name: str) -> str:
        return self.table("bronze", name)

    def silver(self, name: str) -> str:
        return self.table("silver", name)

    def gold(self, name: str) -> str:
        return self.table("gold", name)

    def quarantine(self, name: str) -> str:
        return self.table("quarantine", name)

    def checkpoint(self, name: str) -> str:
        return self.table("_checkpoints", name)

    def schema(self, name: str) -> str:
        return self.table("_schemas", name)

    def monitoring(self, name: str) -> str:
        return self.table("monitoring", name)
