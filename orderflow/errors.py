"""The one exception the toolkit raises for bad input."""


class IngestError(ValueError):
    """A whole input is refused: ``reason`` is a short code, ``detail`` names the culprit."""

    def __init__(self, reason: str, detail: str = ""):
        self.reason = reason
        self.detail = detail
        super().__init__(f"{reason}: {detail}" if detail else reason)
