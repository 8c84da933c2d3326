"""Keys, salts and token vaults: files only their owner can read, outside the output."""
from __future__ import annotations

import json
import os
import secrets
import tempfile
from pathlib import Path

from veilspark.plans.errors import RunError


def private_dir(path: str | Path) -> Path:
    p = Path(path)
    p.mkdir(parents=True, exist_ok=True)
    os.chmod(p, 0o700)
    return p


def write_secret(path: str | Path, data: bytes) -> None:
    """Write through a temporary file of the same folder, then rename."""
    path = Path(path)
    private_dir(path.parent)
    fd, temporary = tempfile.mkstemp(dir=path.parent)
    try:
        os.fchmod(fd, 0o600)
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        os.replace(temporary, path)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def read_map(path: str | Path) -> dict[str, str]:
    p = Path(path)
    if not p.exists():
        return {}
    try:
        found = json.loads(p.read_text())
    except ValueError:
        found = None
    if not isinstance(found, dict):
        raise RunError("KEY_MATERIAL_INVALID", "a key file is not a JSON object", p.name)
    return found


def salt_key(salt: str, owner: str) -> bytes:
    """The 32 bytes of a salt written in hexadecimal."""
    try:
        raw = bytes.fromhex(salt) if salt == salt.strip() else b""
    except ValueError:
        raw = b""
    if len(raw) != 32 or len(salt) != 64:
        raise RunError("KEY_MATERIAL_INVALID", "a salt must be 64 hexadecimal digits", owner)
    return raw


class KeyFolder:
    """Salts and keys by column; without a folder they last for one run."""

    def __init__(self, path: str | Path | None = None):
        self.path = Path(path) if path else None
        self._made: dict[str, dict[str, str]] = {}

    def _file(self, name: str) -> dict[str, str]:
        if name not in self._made:
            self._made[name] = read_map(self.path / name) if self.path else {}
        return self._made[name]

    def _get(self, name: str, column: str, size: int, persist: bool) -> str:
        known = self._file(name)
        if column not in known:
            known[column] = secrets.token_hex(size)
            if persist and self.path:
                write_secret(self.path / name, json.dumps(known, indent=1, sort_keys=True).encode())
        return known[column]

    def salt(self, column: str, persist: bool = False) -> str:
        """A salt of 32 bytes; kept between runs only when asked for."""
        if not persist:
            return self._made.setdefault("#run", {}).setdefault(column, secrets.token_hex(32))
        return self._get("hash_salts.json", column, 32, True)

    def key(self, column: str) -> str:
        """The master key of an encrypted column, kept between runs."""
        return self._get("encryption_keys.json", column, 16, True)


def outside(keys: str | Path, output: str | Path) -> None:
    """Refuse a key folder inside the output folder, or the other way round."""
    k, o = Path(keys).resolve(), Path(output).resolve()
    if k == o or o in k.parents:
        raise RunError("KEY_MATERIAL_IN_OUTPUT", "keys must not lie in the output folder", str(k))
