"""Reference stack walker (stdlib html.parser) for differential DOM tests."""
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param",
        "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer"}


class Walker(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.elems, self.texts = [], [], []

    def _open(self, tag, attrs, void):
        idx = len(self.elems)
        self.elems.append({"name": tag, "attrs": attrs, "depth": len(self.stack),
                           "parent": self.stack[-1] if self.stack else None, "end": None, "text": []})
        if void:
            self.elems[idx]["end"] = len(self.elems)
        else:
            self.stack.append(idx)

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, tag in VOID)

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs, True)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.elems[self.stack[i]]["name"] == tag:
                for j in self.stack[i:]:
                    self.elems[j]["end"] = len(self.elems)
                del self.stack[i:]
                return

    def handle_data(self, data):
        if self.lasttag in ("script", "style") and self.stack and self.elems[self.stack[-1]]["name"] in ("script", "style"):
            return
        for j in self.stack:
            self.elems[j]["text"].append(data)

    def finish(self):
        self.close()
        for j in self.stack:
            self.elems[j]["end"] = len(self.elems)
        self.stack = []
        return self.elems


def walk(html):
    w = Walker()
    w.feed(html)
    return w.finish()
