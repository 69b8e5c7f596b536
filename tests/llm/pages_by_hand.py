"""Pages written and labelled by hand, in layouts of their own: (html, main text blocks)."""

PARAGRAPHS = {
    "en": ["The harbour was rebuilt after the storm of 1953, when the old pier broke into three parts and the fishing boats were carried inland.",
           "Work began in the following spring. Two hundred men from the villages nearby were hired, and most of them stayed for the whole of the four years.",
           "Today the new pier is used by ferries in summer and by the coast guard in winter, although both complain about the narrow entrance.",
           "A plan to widen it was turned down last month, because the council could not agree on who should pay for the dredging."],
    "de": ["Das Museum öffnet am kommenden Sonntag nach zwei Jahren wieder seine Türen, und die Stadt erwartet mehrere tausend Besucher.",
           "Die Sammlung wurde in dieser Zeit neu geordnet. Viele Stücke, die lange im Keller lagen, sind nun zum ersten Mal zu sehen.",
           "Der Eintritt bleibt frei, sagte die Leiterin, aber für die große Ausstellung im Herbst müssen Karten gekauft werden.",
           "Kritik kam von den Anwohnern, die im Sommer über den Lärm der Baustelle geklagt hatten und nun auf Ruhe hoffen."],
    "fr": ["La rivière est sortie de son lit dans la nuit de mardi, et les pompiers ont dû évacuer une trentaine de familles.",
           "Le maire a demandé l'aide de l'État. Selon lui, les digues construites il y a vingt ans ne suffisent plus à protéger le bourg.",
           "Les habitants, eux, se souviennent de la crue de 1994, quand l'eau était montée jusqu'au premier étage de l'école.",
           "Une réunion publique aura lieu vendredi soir à la salle des fêtes, et les travaux pourraient commencer avant la fin de l'année."],
}


def _p(texts, tag="p"):
    return "".join(f"<{tag}>{t}</{tag}>" for t in texts)


def pages():
    en, de, fr = PARAGRAPHS["en"], PARAGRAPHS["de"], PARAGRAPHS["fr"]
    menu = "".join(f"<li><a href=/{x}>{x}</a></li>" for x in ("Home", "World", "Sport", "Culture", "Contact"))
    return [
        # no class names at all
        (f"<html><body><div><a href=/>The Daily Wave</a></div><div><ul>{menu}</ul></div><div><h1>A pier for the harbour</h1>{_p(en[:3])}</div>"
         "<div><p>© 2024 The Daily Wave. All rights reserved.</p></div></body></html>", ["A pier for the harbour", *en[:3]]),
        # a table layout
        (f"<html><body><table><tr><td colspan=2><a href=/>Wave</a></td></tr><tr><td><a href=/1>News</a><br><a href=/2>Sport</a></td>"
         f"<td><h2>A pier for the harbour</h2>{_p(en)}</td></tr><tr><td colspan=2>Copyright The Daily Wave</td></tr></table></body></html>",
         ["A pier for the harbour", *en]),
        # German names
        (f"<html><body><div class=kopfzeile>Abendblatt</div><ul class=hauptnavigation>{menu}</ul><div class=inhalt><h1>Museum öffnet wieder</h1>{_p(de[:3])}</div>"
         "<div class=fusszeile><p>Impressum | Datenschutz | Kontakt</p></div></body></html>", ["Museum öffnet wieder", *de[:3]]),
        # reader comments under a name of their own
        (f"<html><body><nav><ul>{menu}</ul></nav><article><h1>A pier for the harbour</h1>{_p(en)}</article><section class=user-opinions>"
         "<p>Great news, finally!</p><p>I was there in 1953, it was terrible.</p></section><footer>Daily Wave</footer></body></html>",
         ["A pier for the harbour", *en]),
        # French, main and aside
        (f"<html><body><header><h2>Le Courrier</h2></header><main><h1>La rivière déborde</h1>{_p(fr)}</main><aside><h3>À lire aussi</h3>"
         "<a href=/x>Le marché couvert fête ses cent ans</a></aside><footer><p>Mentions légales</p></footer></body></html>", ["La rivière déborde", *fr]),
        # a cookie notice in front, text in plain divs
        (f"<html><body><div class=cc-window>We use cookies to give you the best experience. <button>Accept</button></div><div id=x1><a href=/>Home</a> <a href=/n>News</a></div>"
         f"<div id=x2>{_p(en, 'div')}</div><div id=x3>Terms of use</div></body></html>", en),
        # a list and a quotation inside the article
        (f"<html><body><ul class=nav>{menu}</ul><div class=post><h1>Four facts</h1><p>{en[0]}</p><ul><li>{en[1]}</li><li>{en[2]}</li></ul><blockquote>{en[3]}</blockquote></div>"
         "<div class=related><a href=/1>Another pier</a><a href=/2>A lighthouse</a></div></body></html>", ["Four facts", en[0], en[1], en[2], en[3]]),
        # scripts with markup and comments inside
        (f"<html><head><script>for(i=0;i<n;i++)document.write('<p>no</p>')</script></head><body><div class=menu><ul>{menu}</ul></div><div class=content><h1>La rivière</h1>"
         f"<script>if(a<b&&c>d){{x='</div>'}}<!-- y --></script>{_p(fr[:3])}</div><!-- <p>old</p> --><div class=footer>Plan du site</div></body></html>", ["La rivière", *fr[:3]]),
        # share links and an advert between the paragraphs
        (f"<html><body><div class=header><a href=/>Wave</a></div><div class=entry><h1>A pier for the harbour</h1><p>{en[0]}</p><div class=share><a href=#>Share</a> <a href=#>Tweet</a></div>"
         f"<p>{en[1]}</p><div class=ad>Buy a boat today!</div><p>{en[2]}</p></div><div class=comments><p>Nice.</p></div></body></html>",
         ["A pier for the harbour", en[0], en[1], en[2]]),
        # a sign-up form below
        (f"<html><body><nav><a href=/>Start</a></nav><section class=story><h1>Museum öffnet wieder</h1>{_p(de)}</section>"
         "<form><label>E-Mail</label><input><button>Newsletter bestellen</button></form><footer>© Abendblatt</footer></body></html>", ["Museum öffnet wieder", *de]),
    ]
