"""What a run takes from outside its configuration: folders, storage credentials, a judge's key.

Values come from the process environment, which a ``.env`` file fills in first. A secret is
held so that printing it shows only whether it is set.
"""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Mapping, MutableMapping
from dataclasses import dataclass
from pathlib import Path

log = logging.getLogger(__name__)

ENV_FILE = "SIEVELINE_ENV_FILE"
#: The names searched for, in this order, in a folder and those above it.
FILES = (".env", ".env.local")
#: One assignment of a ``.env`` file: an optional ``export``, a name, and the rest of the line.
LINE = re.compile(r"^[^\S\n]*(?:export[^\S\n]+)?(?P<name>[^\s#=][^=\n]*?)[^\S\n]*=[^\S\n]*(?P<value>.*?)[^\S\n]*$", re.MULTILINE)
QUOTED = re.compile(r"""(?s)^(['"])(.*)\1$""")


class Secret:
    """A value that isn't shown; ``reveal()`` gives it."""

    __slots__ = ("_value",)

    def __init__(self, value: str):
        self._value = value

    def reveal(self) -> str:
        return self._value

    def __repr__(self) -> str:
        return "Secret(***)"

    __str__ = __repr__


def parse(text: str) -> dict[str, str]:
    """``NAME=value`` lines. ``export`` and a matching pair of quotes are dropped; ``#`` begins a comment line; nothing is interpolated."""
    return {m["name"]: QUOTED.sub(r"\2", m["value"]) for m in LINE.finditer(text)}


def find(start: Path | None = None, environ: Mapping[str, str] = os.environ) -> Path | None:
    """The file that :data:`ENV_FILE` names, and no other if it names one; else the nearest at ``start`` or above it."""
    if named := environ.get(ENV_FILE):
        at = Path(named).expanduser()
        return at if at.is_file() else None
    here = (start or Path.cwd()).resolve()
    candidates = (folder / name for folder in (here, *here.parents) for name in FILES)
    return next((c for c in candidates if c.is_file()), None)


def fill(path: Path | None = None, start: Path | None = None, override: bool = False, environ: MutableMapping[str, str] = os.environ) -> tuple[Path | None, list[str]]:
    """Puts a file's values into the environment and returns the file and the names put; what is set already wins unless ``override``."""
    path = path or find(start, environ)
    if path is None:
        return None, []
    try:
        said = parse(path.read_text(encoding="utf-8"))
    except OSError as e:
        log.warning("%s can't be read: %s", path, e.strerror)
        return None, []
    new = {n: v for n, v in said.items() if override or n not in environ}
    environ.update(new)
    if new:
        log.info("%s: %s", path, ", ".join(sorted(new)))
    return path, list(new)


#: Families of credentials in the order they are tried, with the variables of each.
FAMILIES = {
    "digitalocean": {"access_key": ["DO_SPACES_ACCESS_KEY"], "secret_key": ["DO_SPACES_SECRET_KEY"], "endpoint": ["DO_SPACES_ENDPOINT"], "region": ["DO_SPACES_REGION"], "bucket": ["DO_SPACES_BUCKET"], "bucket_url": ["DO_SPACES_BUCKET_URL"]},
    "aws": {"access_key": ["AWS_ACCESS_KEY_ID"], "secret_key": ["AWS_SECRET_ACCESS_KEY"], "endpoint": ["AWS_ENDPOINT_URL"], "region": ["AWS_DEFAULT_REGION", "AWS_REGION"], "bucket": ["AWS_S3_BUCKET"], "bucket_url": []},
    "s3": {"access_key": ["S3_ACCESS_KEY", "S3_ACCESS_KEY_ID"], "secret_key": ["S3_SECRET_KEY", "S3_SECRET_ACCESS_KEY"], "endpoint": ["S3_ENDPOINT_URL"], "region": ["S3_REGION"], "bucket": ["S3_BUCKET"], "bucket_url": []},
}
#: Families that find their endpoint by the region.
WITHOUT_ENDPOINT = {"aws"}
ANY_BUCKET = "S3_BUCKET"


@dataclass(frozen=True)
class Storage:
    """Credentials of one family. Keys, endpoint and region are never mixed between families; a bucket may come from :data:`ANY_BUCKET`."""

    family: str | None = None
    access_key: Secret | None = None
    secret_key: Secret | None = None
    endpoint: str | None = None
    region: str | None = None
    bucket: str | None = None
    bucket_url: str | None = None
    ignored: tuple[str, ...] = ()

    @classmethod
    def of(cls, environ: Mapping[str, str], pinned: str | None = None) -> Storage:
        """The pinned family, whether complete or not; else the first with both keys; else what there is of any, without a family."""
        seen = {name: {k: _first(environ, *names) for k, names in parts.items()} for name, parts in FAMILIES.items()}
        whole = [name for name, v in seen.items() if v["access_key"] and v["secret_key"]]
        if pinned and pinned not in FAMILIES:
            raise ValueError(f"storage family {pinned!r} isn't known; use one of {', '.join(FAMILIES)}")
        family = pinned or (whole[0] if whole else None)
        begun = (name for name, v in seen.items() if v["access_key"] or v["secret_key"] or v["endpoint"])
        found = dict(seen[family or next(begun, next(iter(FAMILIES)))])
        found["bucket"] = found["bucket"] or _first(environ, ANY_BUCKET)
        keys = {k: Secret(found.pop(k)) if found[k] else found.pop(k) for k in ("access_key", "secret_key")}
        ignored = () if pinned else tuple(whole[1:])
        if ignored:
            log.warning("credentials of %s are used, those of %s ignored", family, ", ".join(ignored))
        return cls(family, **keys, **found, ignored=ignored)

    def missing(self) -> list[str]:
        """The variables that a client would still need."""
        names = FAMILIES[self.family or next(iter(FAMILIES))]
        need = ["access_key", "secret_key"] + ([] if self.family in WITHOUT_ENDPOINT else ["endpoint"])
        return [names[n][0] for n in need if not getattr(self, n)]

    def required(self) -> Storage:
        if gaps := self.missing():
            raise RuntimeError(f"object storage isn't configured; missing: {', '.join(gaps)}")
        return self

    def hadoop(self) -> dict[str, str]:
        """Spark settings for ``s3a://`` paths."""
        self.required()
        out = {"access.key": self.access_key.reveal(), "secret.key": self.secret_key.reveal(), "endpoint": self.endpoint, "endpoint.region": self.region}  # type: ignore[union-attr]
        return {f"spark.hadoop.fs.s3a.{k}": v for k, v in out.items() if v}

    def mirror(self, environ: MutableMapping[str, str] = os.environ) -> list[str]:
        """Writes the usual AWS names for other tools, those that aren't set, and returns them."""
        plain = {"AWS_ACCESS_KEY_ID": self.access_key, "AWS_SECRET_ACCESS_KEY": self.secret_key, "AWS_DEFAULT_REGION": self.region, "AWS_ENDPOINT_URL": self.endpoint}
        new = {n: v.reveal() if isinstance(v, Secret) else v for n, v in plain.items() if v and not environ.get(n)}
        environ.update(new)
        return list(new)


@dataclass(frozen=True)
class Judge:
    """Access to a model that judges pairs."""

    api_key: Secret | None = None
    base_url: str | None = None
    organization: str | None = None

    def required(self) -> Judge:
        if self.api_key is None:
            raise RuntimeError("OPENAI_API_KEY isn't set: the review needs it, or a judge of its own, or to be disabled")
        return self


@dataclass(frozen=True)
class Environment:
    """All of it. Folders and the manifest outrank the configuration file, and an explicit argument outranks them."""

    storage: Storage
    judge: Judge
    input_dir: str | None = None
    output_dir: str | None = None
    cache_dir: str | None = None
    manifest: str | None = None
    env_file: Path | None = None

    @classmethod
    def load(cls, env_file: Path | None = None, start: Path | None = None, override: bool = False, environ: MutableMapping[str, str] = os.environ) -> Environment:
        path, _ = fill(env_file, start, override, environ)
        get = lambda *names: _first(environ, *names)
        key = get("OPENAI_API_KEY")
        folder = {n: get(f"SIEVELINE_{n.upper()}") for n in ("input_dir", "output_dir", "cache_dir", "manifest")}
        return cls(
            Storage.of(environ, (get("SIEVELINE_STORAGE") or "").lower() or None),
            Judge(Secret(key) if key else None, get("OPENAI_BASE_URL", "OPENAI_API_BASE"), get("OPENAI_ORG_ID", "OPENAI_ORGANIZATION")),
            **{n: v and str(Path(v).expanduser()) for n, v in folder.items()},
            env_file=path,
        )

    def described(self) -> dict[str, str]:
        """Each setting, secrets only as set or not."""
        say = lambda v: "not set" if not v else "set" if isinstance(v, Secret) else str(v)
        own = {n: say(getattr(self, n)) for n in ("env_file", "input_dir", "output_dir", "cache_dir", "manifest")}
        s = self.storage
        own["storage"] = (s.family or "none") + (f" (ignored: {', '.join(s.ignored)})" if s.ignored else "")
        own |= {f"storage.{n}": say(getattr(s, n)) for n in ("endpoint", "region", "bucket", "bucket_url", "access_key", "secret_key")}
        return own | {"judge.api_key": say(self.judge.api_key), "judge.base_url": say(self.judge.base_url)}


def _first(environ: Mapping[str, str], *names: str) -> str | None:
    return next((v for n in names if (v := environ.get(n, "").strip())), None)


def main(args: list[str] | None = None) -> int:
    """``python -m sieveline.environment``: what is configured. Exit 1 if something that ``--require`` names isn't."""
    import argparse

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("--env-file", type=Path)
    p.add_argument("--export-aws", action="store_true")
    p.add_argument("--require", choices=["storage", "judge"], action="append", default=[])
    a = p.parse_args(args)
    own = Environment.load(a.env_file)
    if a.export_aws:
        own.storage.mirror()
    for name, value in own.described().items():
        print(f"{name}: {value}")
    failed = 0
    for need in a.require:
        try:
            getattr(own, need).required()
        except RuntimeError as e:
            print(f"error: {e}")
            failed = 1
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
