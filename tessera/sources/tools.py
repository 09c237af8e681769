"""External tools and the environment of models on executors (SRC23, MDL9, MDL12)."""

from __future__ import annotations

import copy
import json
import os
import shutil

from tessera.sources.ranged import opened

# Fixed values that results must agree on.
CACHE_VARIABLES = {"HF_HOME": "", "HF_HUB_CACHE": "hub", "HF_XET_CACHE": "xet"}
VIT_BOX = [192, 256]


def tool(name: str, explicit: str | None = None, fallbacks: tuple[str, ...] = ()) -> str:
    """Where a tool is: the path given, which must be a file; else on PATH; else the first fallback that is a file."""
    if explicit is not None:
        path = os.path.realpath(os.path.expanduser(explicit))
        if not os.path.isfile(path):
            raise FileNotFoundError(f"{name} is not at {path}")
        return path
    found = shutil.which(name)
    if found:
        return os.path.realpath(found)
    for path in fallbacks:
        if os.path.isfile(path):
            return path
    raise FileNotFoundError(f"{name} is neither on PATH nor at {', '.join(fallbacks) or 'a known place'}")


def cache_environment(root: str) -> dict[str, str]:
    """Make the folders of a model cache and point the variables of this process to them."""
    base = os.path.realpath(os.path.expanduser(root))
    made = {k: os.path.join(base, v) if v else base for k, v in CACHE_VARIABLES.items()}
    for path in made.values():
        os.makedirs(path, exist_ok=True)
    os.environ.update(made)
    return made


def fixed_config(config: dict) -> dict:
    """A stored configuration as models load it: a vision transformer without the shape of its boxes gets it."""
    out = copy.deepcopy(config)
    model = out.get("MODEL", {})
    if model.get("BACKBONE", {}).get("TYPE") == "vit" and "BBOX_SHAPE" not in model:
        model["BBOX_SHAPE"] = list(VIT_BOX)
    return out


def stored_config(path: str) -> dict:
    """The fixed-up configuration of a JSON file on any file system."""
    f, data = opened(path)
    with f:
        return fixed_config(json.loads(data.at(0, data.size)))
