"""A judge of pairs behind an HTTP interface for chat models that see pictures."""

from __future__ import annotations

import base64
import json
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from sieveline.environment import Judge

QUESTION = (
    "Each of the two clips below is shown by frames taken from it. Say whether a learner would gain something from the second that the first doesn't offer. "
    "They are DISTINCT if task, step, place, tool or material differ. They are REDUNDANT if one and the same activity is shown, even under another angle, light or colour, or at another moment. "
    'Answer with one JSON object only: {"verdict": "DISTINCT" or "REDUNDANT", "confidence": a number from 0 to 1, "reason": one short sentence}.'
)
#: Fixed value: where the interface lies if nothing else is said.
BASE_URL = "https://api.openai.com/v1"


def _send(request: urllib.request.Request) -> bytes:
    with urllib.request.urlopen(request, timeout=120) as answer:  # noqa: S310  a configured address
        return answer.read()


@dataclass
class ChatJudge:
    """Called with two ids and the paths of their frames, returns the model's reply. ``send`` can be replaced."""

    access: Judge
    model: str
    max_output_tokens: int = 300
    send: Callable[[urllib.request.Request], bytes] = _send

    def body(self, left: list[str], right: list[str]) -> dict:
        picture = lambda p: {"type": "image_url", "image_url": {"url": "data:image/jpeg;base64," + base64.b64encode(Path(p).read_bytes()).decode()}}
        text = lambda t: {"type": "text", "text": t}
        content = [text(QUESTION), text("Clip A:"), *map(picture, left), text("Clip B:"), *map(picture, right)]
        return {"model": self.model, "messages": [{"role": "user", "content": content}], "max_tokens": self.max_output_tokens, "temperature": 0.0}

    def __call__(self, a: str, b: str, left: list[str], right: list[str]) -> str:
        key = self.access.required().api_key
        headers = {"Authorization": f"Bearer {key.reveal()}", "Content-Type": "application/json"}  # type: ignore[union-attr]
        if self.access.organization:
            headers["OpenAI-Organization"] = self.access.organization
        url = (self.access.base_url or BASE_URL).rstrip("/") + "/chat/completions"
        request = urllib.request.Request(url, json.dumps(self.body(left, right)).encode(), headers)  # noqa: S310
        return json.loads(self.send(request))["choices"][0]["message"]["content"] or ""
