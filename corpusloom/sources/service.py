"""A model service and attachments over HTTP; ``send`` (request -> bytes) is injected, so tests need no network."""

from __future__ import annotations

import json
import urllib.request
import uuid
from collections.abc import Callable
from pathlib import Path

from corpusloom.operators import prompts

Send = Callable[[urllib.request.Request], bytes]


def over_http(request: urllib.request.Request) -> bytes:
    with urllib.request.urlopen(request, timeout=600) as answer:
        return answer.read()


def fetch_json(url: str, send: Send = over_http, token: str | None = None):
    """The JSON document at an address: an attachment, or a page of a listing."""
    head = {"Accept": "application/json"} | ({"Authorization": f"Bearer {token}"} if token else {})
    return json.loads(send(urllib.request.Request(url, headers=head)))


class Responses:
    """Single answers, and batches (see ``plans.jobs.Service``)."""

    def __init__(self, key: str, url: str, send: Send = over_http) -> None:
        self.key, self.url, self.send = key, url.rstrip("/"), send

    def _ask(self, path: str, body: bytes | None = None, kind: str = "application/json") -> bytes:
        head = {"Authorization": f"Bearer {self.key}"} | ({"Content-Type": kind} if body is not None else {})
        return self.send(urllib.request.Request(f"{self.url}{path}", data=body, headers=head))

    def answer(self, task: prompts.Task, prompt: str) -> dict:
        """text and usage of one answer; an answer without text is an error, as are those of the transport."""
        body = {"model": task.model, "input": [{"role": "user", "content": prompt}], "max_output_tokens": task.max_output_tokens}
        if task.model.startswith("gpt-5"):
            body |= {n: {k: v} for n, k, v in (("text", "verbosity", task.verbosity), ("reasoning", "effort", task.reasoning_effort)) if v}
        said = json.loads(self._ask("/v1/responses", json.dumps(body).encode()))
        texts = [c["text"] for b in reversed(said.get("output") or []) if b.get("type") == "message" for c in b.get("content") or [] if c.get("text")]
        text = said.get("output_text") or next(iter(texts), None)
        if not text:
            raise ValueError("the service's answer has no text")
        return {"text": text, "usage": said.get("usage")}

    def submit(self, requests: str, endpoint: str, window: str) -> dict:
        """Upload the request lines (a file or a folder of them) and start a batch."""
        path, mark = Path(requests), uuid.uuid4().hex
        lines = b"".join(p.read_bytes() for p in (sorted(path.glob("part-*")) if path.is_dir() else [path]))
        form = f'--{mark}\r\nContent-Disposition: form-data; name="purpose"\r\n\r\nbatch\r\n--{mark}\r\nContent-Disposition: form-data; name="file"; filename="requests.jsonl"\r\nContent-Type: application/jsonl\r\n\r\n'.encode() + lines + f"\r\n--{mark}--\r\n".encode()
        file = json.loads(self._ask("/v1/files", form, f"multipart/form-data; boundary={mark}"))["id"]
        made = json.loads(self._ask("/v1/batches", json.dumps({"input_file_id": file, "endpoint": endpoint, "completion_window": window}).encode()))
        return made | {"input_file_id": file, "status": made.get("status") or "submitted"}

    def retrieve(self, batch_id: str) -> dict:
        return json.loads(self._ask(f"/v1/batches/{batch_id}"))

    def download(self, file_id: str, to: str) -> None:
        Path(to).write_bytes(self._ask(f"/v1/files/{file_id}/content"))
