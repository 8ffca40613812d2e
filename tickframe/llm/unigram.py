"""A SentencePiece vocabulary read as a unigram model: pieces, scores, fallback bytes, pre-tokens.

The vocabulary file holds BPE pieces in order of rank and no probabilities. A piece of rank r is given Zipf's
log probability, -ln(r + 1) - ln(H), scaled by 1000 and rounded to an integer, so that sums and ties are exact.
"""

from __future__ import annotations

import math
import re

#: Marks a space inside pieces.
SPACE = "▁"
SCALE = 1000
#: Below the least score by so much lies a character without a piece, which is spelt in bytes.
UNKNOWN_PENALTY = 10
#: No piece holds a newline, and none holds a space mark after another character, so the best path of a text is
#: made of the best paths of these parts.
PRETOKEN = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
#: The same in Java's syntax.
PRETOKEN_SQL = rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    def __init__(self, path: str | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        harmonic = math.log(sum(1 / (r + 1) for r in range(len(normal))))
        self.pieces: dict[str, tuple[int, int]] = {sp.id_to_piece(i): (i, -round(SCALE * (math.log(r + 1) + harmonic))) for r, i in enumerate(normal)}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        self.unknown_id = sp.unk_id()
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece crosses pre-tokens")
        self.text = {i: p.replace(SPACE, " ") for p, (i, _) in self.pieces.items()}

    def byte_count(self, ch: str) -> int:
        return len(ch.encode("utf-8", "surrogatepass")) if self.bytes else 1

    def byte_ids(self, ch: str) -> list[int]:
        return [self.bytes[b] for b in ch.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown_id]

    def spellings(self) -> list[bytes]:
        """The bytes of each id."""
        out = [b""] * (max([*self.text, *self.bytes.values(), self.unknown_id]) + 1)
        for i, text in self.text.items():
            out[i] = text.encode("utf-8", "surrogatepass")
        for b, i in self.bytes.items():
            out[i] = bytes([b])
        return out

    def decode(self, ids) -> str:
        """Text of token ids; the leading space that encoding adds is taken off."""
        out, run = [], bytearray()
        back = getattr(self, "_back", None)
        if back is None:
            back = self._back = {i: b for b, i in self.bytes.items()}
        for i in ids:
            if i in back:
                run.append(back[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.text.get(i, ""))
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text


def marked(text: str | None) -> str:
    """Text as the lattice sees it: spaces as marks, one more in front; nothing for an empty text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def pretokens(text: str | None) -> list[str]:
    return PRETOKEN.findall(marked(text))
