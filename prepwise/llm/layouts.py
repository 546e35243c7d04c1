"""Training pages: texts of real pages set again into page layouts of many kinds, every block labelled.

Real pages say by their elements which texts are the article and which are not (see ``own_labels``).
Those texts, with usual phrases of menus, notices and comment forms, are set into layouts that mark
their parts by elements, by class names or hardly at all, so that the labeller has to use the words,
the links and the neighbourhood as well."""
from __future__ import annotations

import html
import random
import re

from .markup import Page, parse

INSIDE, OUTSIDE = "\ue001", "\ue000"                                # private-use marks that set off labelled texts

# FIXED VALUES: usual names of page parts, and phrases of such parts in four languages
NAMES = {
    "content": "content main article post entry story body-text post-content article-body entry-content main-content text page-content blog-post",
    "menu": "nav menu navbar navigation main-menu topnav site-nav breadcrumb breadcrumbs pagination pager toc skip-links",
    "head": "header site-header masthead top banner topbar page-header logo brand",
    "foot": "footer site-footer bottom page-footer copyright legal colophon footer-links",
    "side": "sidebar aside side widget widgets right-col left-col secondary rail related related-posts recommended popular trending tags",
    "notice": "notice cookie cookie-banner consent gdpr alert message warning popup modal overlay announcement paywall",
    "advert": "ad ads advert advertisement sponsored promo banner-ad sponsor commercial adsense",
    "form": "form search search-form newsletter subscribe login signup contact-form register",
    "comments": "comments comment comment-list commentlist discussion responses replies reader-comments disqus comment-body",
    "share": "share social sharing share-buttons social-links follow author-bio meta byline",
}
TAGS = {"content": ("article", "main", "section"), "menu": ("nav",), "head": ("header",), "foot": ("footer",), "side": ("aside",),
        "notice": ("aside", "dialog"), "advert": ("aside",), "form": ("form",), "comments": ("section", "aside"), "share": ("aside", "footer")}
PHRASES = {
    "menu": "Home|About|About us|Contact|News|Blog|Products|Services|Login|Sign in|Sitemap|Next|Previous|Skip to content|Archive|Accueil|À propos|Contact|"
            "Suivant|Startseite|Über uns|Kontakt|Weiter|Zurück|Inicio|Acerca de|Contacto|Siguiente|Noticias|Shop|FAQ|Help|Careers|Menu",
    "head": "My site|The daily page|Welcome|Just another site|Bienvenue|Willkommen|Bienvenidos|Home of good pages",
    "foot": "© 2024 Example Inc. All rights reserved.|Copyright 2023|Terms of service|Privacy policy|Imprint|Mentions légales|Impressum|Datenschutz|"
            "Tous droits réservés.|Alle Rechte vorbehalten.|Todos los derechos reservados.|Aviso legal|Powered by our pages|Back to top",
    "side": "Related articles|Popular posts|Recent posts|Read more|You may also like|Tags|Categories|Archives|À lire aussi|Mehr zum Thema|"
            "Artículos relacionados|Trending now|Editor's picks|Most read",
    "notice": "We use cookies to improve your experience.|Accept all cookies|This site uses cookies. By continuing you agree.|Nous utilisons des cookies.|"
              "Wir verwenden Cookies.|Utilizamos cookies.|Please enable JavaScript.|Your browser is out of date.|Manage preferences|Subscribe to read on.",
    "advert": "Advertisement|Sponsored|Buy now and save 20%|Special offer|Publicité|Anzeige|Publicidad|Limited time offer: order today!|Learn more|Shop now",
    "form": "Search|Email address|Your name|Subscribe|Subscribe to our newsletter|Sign up|Password|Submit|Remember me|Rechercher|Suchen|Buscar|Send|Required field",
    "comments": "Comments|3 comments|Leave a reply|Reply|Report|Log in to comment|Commentaires|Kommentare|Comentarios|Great post, thanks!|I agree with this.|"
                "First!|Thanks for sharing|Posted by guest|2 hours ago|Like|Antworten|Répondre|Responder",
    "share": "Share|Tweet|Share on social media|Follow us|Print|Email this|Partager|Teilen|Compartir|Written by the editors|5 min read|Share this article",
}
_CONTENT = frozenset(("<article", "<main", "=article", "=main"))
_NOT_CONTENT = frozenset(("<nav", "<footer", "<aside", "<form", "<dialog", "<button", "<select", "<textarea", "=hidden", "ad", "ads", "comments", "comment"))


def chains(page: Page) -> list[tuple]:
    """All path tokens of every element, from the outermost one in."""
    found = [()]
    for parent, tokens in zip(page.parents[1:], page.tokens[1:]):
        found.append(found[parent] + tokens)
    return found


def own_labels(page: Page) -> list[int] | None:
    """1 for blocks inside the article element (not in a part of it that is no article), else 0; none without one."""
    paths = [set(p) for p in chains(page)]
    if not any(p & _CONTENT for p in paths):
        return None
    return [int(bool(paths[node] & _CONTENT) and not paths[node] & _NOT_CONTENT) for node, _, _ in page.blocks]


class Layouts:
    """Random pages from pools of article texts and of other texts."""

    def __init__(self, articles: list[list[str]], others: list[str], seed: int):
        self.r = random.Random(seed)
        self.articles = articles or [self._invented() for _ in range(40)]
        self.others = others or ["Home"]

    def _invented(self) -> list[str]:
        r = self.r
        syllables = "the an er on re in st ing ou de la en ch ge be un que ci es ra mo ti no".split()
        word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))          # noqa: E731
        sentence = lambda: " ".join(word() for _ in range(r.randint(2, 18))).capitalize() + r.choice([".", ".", ".", "!", "?", ""])     # noqa: E731
        return [sentence(), *[" ".join(sentence() for _ in range(r.randint(1, 8))) for _ in range(r.randint(1, 12))]]

    def _open(self, kind: str, style: str) -> tuple[str, str]:
        r = self.r
        by_tag = style == "tags" or style == "both" and r.random() < 0.5
        tag = r.choice(TAGS[kind]) if by_tag else r.choice(["div", "div", "div", "section", "td"] if kind != "form" else ["div", "form"])
        if kind == "form" and style == "bare":
            tag = "form"
        attribute = ""
        if style in ("names", "both") or by_tag and r.random() < 0.3:
            name = r.choice(NAMES[kind].split())
            attribute = r.choice([f' class="{name}"', f' id="{name}"', f' class="box {name}"', f" class='{name} clearfix col-{r.randint(1, 12)}'"])
        return ("<table><tr><td>", "</td></tr></table>") if tag == "td" and not attribute else (f"<{tag}{attribute}>", f"</{tag}>")

    def _text(self, mark: str, text: str) -> str:
        return mark + html.escape(text, quote=False)

    def _phrase(self, kind: str) -> str:
        r = self.r
        if r.random() < 0.25:
            words = r.choice(self.others).split() or ["x"]
            at = r.randrange(len(words))
            return " ".join(words[at:at + r.randint(1, 6)])
        return r.choice(PHRASES[kind].split("|"))

    def _part(self, kind: str, style: str) -> str:
        """A part of the page that is not the article."""
        r = self.r
        start, end = self._open(kind, style)
        out = []
        for _ in range(r.randint(1, 4) if kind in ("notice", "advert", "share", "head") else r.randint(2, 8)):
            text = self._text(OUTSIDE, self._phrase(kind))
            if kind in ("menu", "side", "foot", "share") and r.random() < 0.85:
                text = f'<a href="/{r.randint(1, 99)}">{text}</a>'
                out.append(r.choice(["<li>{}</li>", "<li>{}</li>", "<p>{}</p>", "<div>{}</div>"]).format(text))
            elif kind == "form":
                out.append(r.choice(["<label>{}</label><input>", "<button>{}</button>", "<p>{}</p>"]).format(text))
            elif kind == "comments" and style != "bare" and r.random() < 0.6:
                out.append(r.choice(["<p>{}</p>", "<li><p>{}</p></li>", "<div>{}</div>"]).format(self._text(OUTSIDE, r.choice(r.choice(self.articles)))))
            elif kind in ("side", "notice", "advert") and style != "bare" and r.random() < 0.3:
                out.append(f"<p>{self._text(OUTSIDE, r.choice(r.choice(self.articles))[:r.randint(20, 400)])}</p>")
            else:
                out.append(r.choice(["<p>{}</p>", "<div>{}</div>", "<h3>{}</h3>", "<span>{}</span><br>"]).format(text))
        inner = "".join(out)
        return start + (f"<ul>{inner}</ul>" if kind == "menu" and "<li>" in inner else inner) + end

    def _article(self, style: str) -> str:
        r = self.r
        texts = [t for t in r.choice(self.articles) if t.strip()]
        at = r.randrange(max(1, len(texts) - 40))
        out = []
        for k, text in enumerate(texts[at:at + 40]):
            if style != "bare" and r.random() < 0.06:             # a line that also stands in other parts is kept inside the article
                text = self._phrase(r.choice([*PHRASES]))
            inner = self._text(INSIDE, text)
            words = text.split()
            if r.random() < 0.12 and len(words) > 6:
                inner = self._text(INSIDE, " ".join(words[:3])) + f' <a href="/x">{html.escape(words[3])}</a> ' + html.escape(" ".join(words[4:]))
            if k == 0 and r.random() < 0.8:
                out.append(f"<h1>{inner}</h1>")
            else:
                out.append(r.choice(["<p>{}</p>"] * 8 + ["<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<p><b>{}<br>", "<div>{}</div>",
                                                         "<pre>{}</pre>"]).format(inner))
            if r.random() < 0.06:
                out.append(self._part(r.choice(["advert", "side", "share", "notice"]), "both" if style == "bare" else style))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        style = r.choice(["tags", "names", "names", "both", "both", "bare"])
        start, end = self._open("content", style)
        before = [self._part(k, style) for k in r.sample(["head", "menu", "menu", "notice", "advert", "form"], r.randint(0, 4))]
        after = [self._part(k, style) for k in r.sample(["side", "comments", "share", "advert", "form", "notice", "menu"], r.randint(0, 4))]
        foot = [self._part("foot", style)] if r.random() < 0.8 else []
        body = start + self._article(style) + end
        if r.random() < 0.3:
            start, end = self._open("content", "names") if r.random() < 0.3 else ("<div>", "</div>")
            body = start + body + ("".join(after) if r.random() < 0.5 else "") + end
        whole = "".join(before) + body + ("" if "".join(after) in body else "".join(after)) + "".join(foot)
        return f"<html><head><title>x</title></head><body>{whole}</body></html>" if r.random() < 0.9 else whole

    def example(self) -> tuple[Page, list[int]]:
        """A parsed page and the label of each of its blocks."""
        page = parse(self.page())
        labels = [int(INSIDE in text) for _, text, _ in page.blocks]
        clean = re.compile(f"[{INSIDE}{OUTSIDE}]")
        page.blocks = [(node, clean.sub("", text).strip(), linked - bool(linked)) for node, text, linked in page.blocks]
        keep = [k for k, b in enumerate(page.blocks) if b[1]]
        page.blocks = [page.blocks[k] for k in keep]
        return page, [labels[k] for k in keep]
