"""Error types shared by the three entry points.

Two kinds of failure are told apart, as the stages they mirror do:

* ``ConfigError`` -- the arguments are wrong. Raised before any Spark work,
  and it lists *every* bad argument at once, not just the first.
* ``StageError`` -- the arguments were fine but running failed (missing
  table, refused view, Spark job error, ...). It carries the stage's
  ``detail`` dict so a caller's log shows what the stage was doing.
"""

from __future__ import annotations

from typing import Any


class ConfigError(ValueError):
    """Bad arguments; ``errors`` holds one message per bad argument."""

    def __init__(self, stage: str, errors: list[str]):
        self.stage = stage
        self.errors = list(errors)
        super().__init__(f"{stage}: invalid arguments: " + "; ".join(self.errors))


class StageError(RuntimeError):
    """A stage failed while running; ``detail`` says what it was doing."""

    def __init__(self, stage: str, message: str, detail: dict[str, Any]):
        self.stage = stage
        self.detail = dict(detail)
        super().__init__(f"{stage}: {message}")


class Checks:
    """Collects argument problems so all of them are reported together."""

    def __init__(self, stage: str):
        self.stage = stage
        self.errors: list[str] = []

    def require(self, ok: bool, message: str) -> None:
        if not ok:
            self.errors.append(message)

    def positive_int(self, name: str, value: Any) -> None:
        if value is None:
            return
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            self.errors.append(f"{name} must be a positive integer, got {value!r}")

    def boolean(self, name: str, value: Any) -> None:
        if not isinstance(value, bool):
            self.errors.append(f"{name} must be a boolean, got {value!r}")

    def text(self, name: str, value: Any, *, required: bool = False) -> None:
        if value is None:
            if required:
                self.errors.append(f"{name} is required")
            return
        if not isinstance(value, str) or not value.strip():
            self.errors.append(f"{name} must be a non-empty string, got {value!r}")

    def raise_if_any(self) -> None:
        if self.errors:
            raise ConfigError(self.stage, self.errors)


def wrap(stage: str, detail: dict[str, Any], exc: BaseException) -> StageError:
    """Turn any exception from a running stage into a ``StageError``."""
    if isinstance(exc, StageError):
        return exc
    message = f"{type(exc).__name__}: {exc}"
    return StageError(stage, message, detail)
