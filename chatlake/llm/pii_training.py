"""Sentences with marked personal information, made from a seed and a list of names, in the languages of the texts.

The sentences are invented for the purpose; layouts of numbers are public ones of many countries. In a template, {p} is a
name, {t} a phone number, {e} an e-mail address, {s} a street address, {i} an identity number, {d} a number that is
none of these, {w} an ordinary word in capitals, {g} a listed name that stands for something else.
"""

from __future__ import annotations

import random
import re

#: Signs that stand for others in templates.
_SIGNS = str.maketrans({"¶": "\n", "→": "\t", "¦": "|"})
_SLOT = re.compile(r"\{(\w)\}")
_KIND = {"p": "person", "t": "phone", "e": "email", "s": "address", "i": "id_number"}

# (language, templates); languages choose the layouts of streets.
_WITH = {
    "en": """
Please get in touch with {p} before Friday.|You can reach {p} at {t} or {e}.|Regards,¶{p}|Kind regards, {p}|Hi {p}, the export is ready.|Dear {p},¶the report is attached.|{p} reviewed the change yesterday.|I met {p} at the workshop.|Owner: {p}
Author: {p} <{e}>|Co-authored-by: {p} <{e}>|From: {p} <{e}>|reviewers: {p}, {p}|reviewer={p}|"owner": "{p}", "email": "{e}"|{p} ({e}) asked for access.|Customer {p}, phone {t}, passport {i}.|My name is {p}.|I am {p} and this is my first week.
name: {p}|phone: {t}|email: {e}|address: {s}|tel {t}|mobile {t}|My number is {t}, please ring after six.|Text me at {t} when it breaks.|Her cell is {t}.|Call {t} and ask for {p}.|Emergency contact: {p}, {t}|The office line {t} is busy.|{t} is my direct line.
Send the logs to {e}, thanks.|Forward it to {e} and to {e}.|Mail {e} if anything fails|Write me at {e}.|mailto:{e}|user {e} could not log in|<{e}>|{e}|{p}|{t}|{s}|{i}
We live at {s}.|She moved to {s} last spring.|Deliver the parcel to {s}, please.|Our new office is at {s}.|Home address: {s}|The meeting takes place at {s}.|He lives at {s} with his family.|Visit us: {s}
My passport number is {i}.|passport: {i}|SSN {i}|social security no. {i}|Her social security number, {i}, was in the mail.|tax ID {i}|national insurance number {i}|driver's license {i}|license number {i} belongs to {p}.|The identity card {i} has expired.|ID card: {i}
id={i};name={p};tel={t}|{p};{e};{t};{s}|{p}, {s}, {t}|{p} ¦ {t} ¦ {e}|{p}→{t}→{e}|- {p}: {t}|* {p} – {e}|patient {p}, born in spring, tax no. {i}|According to {p}, the index is fine.|{p} said that the job ran twice.|It was {p} who found it.|Talk to {p}.|thanks {p}!
signed, {p}|@todo ask {p}|# contact {p} ({t})|/* written by {p} */|assignee: {p}|cc {p}|we waited for {p} and {p} all morning|The note by {p} is on the desk.|Did {p} answer you?|Yesterday {p} called from {t}.|{p}'s draft is better.|with {p} on the call
¦ {i} ¦ {s} ¦|¦ {p} ¦ {s} ¦|{s} ¦ {t}|The contract names {s} as the site.|the plan for {s} is ready|Her letter went to {s} by mistake.|{s} has no lift|somebody rang from {t}, twice|{p} made the first draft.|{p} had the idea.|I work with {p} on imports.|my name is {p}, hello|it's {p} speaking
""",
    "de": """
Mein Name ist {p}.|Ich bin {p} aus dem Einkauf.|Bitte rufen Sie {p} unter {t} an.|Meine Handynummer ist {t}.|Telefon: {t}|Meine Adresse: {s}|Ich wohne in der {s}.|Wir ziehen in die {s}.|Reisepass Nr. {i}|Meine Steuer-ID ist {i}.|Personalausweis {i}|Schreib an {e}.|E-Mail: {e}
Viele Grüße¶{p}|Liebe {p}, der Bericht ist fertig.|Ansprechpartner: {p}, {t}|Herr {p} hat angerufen.|Danke an {p} für den Hinweis.
""",
    "fr": """
Mon nom est {p}.|Bonjour, ici {p}.|Appelez-moi au {t}.|Téléphone : {t}|Mon adresse : {s}|J'habite au {s}.|Nous habitons {s}.|Passeport n° {i}|Ma carte d'identité {i} est perdue.|Écrivez à {e}.|Cordialement,¶{p}|Merci à {p} pour son aide.|Contact : {p}, {e}|Chère {p}, tout est prêt.
""",
    "es": """
Mi nombre es {p}.|Soy {p}, del equipo de datos.|Mi teléfono es el {t}.|Llámame al {t} mañana.|Vivo en {s}.|Mi dirección es {s}.|DNI {i}|Mi pasaporte es {i}.|Escribe a {e}.|Saludos,¶{p}|Contacto: {p}, {t}|Hola {p}, ya terminó.|Gracias a {p} por todo.
""",
    "pt": """
Chamo-me {p}.|Meu nome é {p}.|O meu telemóvel é {t}.|Ligue para {t}.|Moro na {s}.|Endereço: {s}|CPF {i}|Passaporte: {i}|Envie para {e}.|Contato: {p}, {e}|Abraço,¶{p}|Olá {p}, está pronto.
""",
    "ru": """
Моё имя {p}.|Я {p}, новый коллега.|Мой номер телефона {t}.|Звоните {t}.|Мой адрес: {s}|Живу на {s}.|Паспорт {i}|ИНН {i}|Пишите на {e}.|С уважением, {p}|Контакт: {p}, {t}|Здравствуйте, {p}!
""",
    "pl": """
Mam na imię {p}.|Jestem {p} z działu danych.|Mój telefon to {t}.|Zadzwoń: {t}|Mieszkam przy {s}.|Adres: {s}|PESEL {i}|Numer paszportu {i}|Napisz do {e}.|Pozdrawiam, {p}|Kontakt: {p}, {e}
""",
    "tr": """
Benim adım {p}.|Ben {p}, yeni geldim.|Telefonum {t}.|Beni {t} numarasından arayın.|Adresim: {s}|Pasaport {i}|Kimlik no {i}|{e} adresine yazın.|Sayın {p}, rapor hazır.|Sevgili {p}, teşekkürler.
""",
    "el": """
Με λένε {p}.|Το όνομά μου είναι {p}.|Το τηλέφωνό μου είναι {t}.|Τηλ. {t}|Διεύθυνση: {s}|Μένω στην {s}.|Διαβατήριο {i}|Ταυτότητα {i}|Γράψε στο {e}.|Αγαπητέ {p}, είναι έτοιμο.
""",
    "zh": """
我的名字是{p}。|我是{p}，新来的。|我的电话是{t}。|手机：{t}|我住在{s}。|地址：{s}|身份证号：{i}|护照号码 {i}|请发到 {e}。|联系人：{p}，{t}|谢谢{p}的帮助。
""",
    "ja": """
私の名前は{p}です。|担当は{p}です。|携帯は{t}です。|電話番号：{t}|自宅は{s}です。|住所：{s}|パスポート番号 {i}|旅券 {i}|{e} までお願いします。|{p}さん、できました。|連絡先：{p}、{t}
""",
}

_WITHOUT = """
The build {d} failed on the second stage.|Order {d} was shipped on Monday.|order number {d}|Invoice no. {d} is open.|Ticket {d} can be closed.|Version {d} fixes it.|v{d} is out|timestamp {d}|epoch={d}|The clock said {d} at that time.|ts: {d}|Checksum {d} does not match.|Serial {d}|commit {d}
Batch {d}, line {d}.|It processed {d} rows in {d} ms.|Range {d} to {d}.|offset {d}|"id": {d}|id={d}|record {d} was skipped|tracking {d}|ISBN {d}|Port {d} is taken.|ping {d}|The host {d} does not answer.|{d}|size {d} bytes|Run {d} again.|sku {d}|pid {d}|on {d} at noon|part {d}|{d}: ok|reference {d}
git clone git@{h}:team/{v}.git|ssh git@{h}|origin git@{h}:core/{v}|npm install {v}@{n}|{v}@{n} has a bug|pip install {v}=={n}|@{v}¶def run():|@{v}(name="x")|import {{x}} from "@{v}/core"|@{v} please see|docker pull {h}/{v}@sha256|user@localhost:/srv|deploy@{h}:/srv/{v}|scp {v}@{h}:~/x .
The {w} job is slow.|{w} starts at noon.|See {w} and {w} for more.|Use {w} instead of {w}.|{w} {w} is the default.|Open {w} Settings and press Save.|New York and San Marino are far.|In {w} we trust the cache.|Could {w} read it?|{w}: done|# {w} {w}|## {w} and {w}|- {w}|¦ {w} ¦ {w} ¦|class {w}Parser:|The {w} {w} is late.
{g} we begin?|{g} I ask something?|The {g} came in late.|a {g} of {d} rows|it will {g} again|He has a {g} idea.|In {g} the load doubles.|the {g} table|{g} is a word too, like any other.|no {g} today|Try to {g} it.|a {g} red line|{g} of fare: {d}|{g} has thirty-one days.|we had {g} and rain
{d} Way merges were slow.|Lane {d} is closed.|It took {d} Drive swaps.|Court is in session at {d}.|Take the road {d} miles south.|place {d} of them in one row|Square {d} is empty.|The way {d} of them fell is odd.|{d} places left on the list|a square of {d} by {d}|Drive {d} failed and drive {d} is spare.|{d} street lights are out|We close {d} tickets a day.
Der Auftrag {d} ist fertig.|Zeile {d} ist leer.|Die Rechnung {d} ist offen.|{w} ist langsam.|Der {w} und die {w} laufen.|La commande {d} est partie.|La ligne {d} est vide.|El pedido {d} llegó tarde.|A encomenda {d} chegou.|Заказ {d} готов.|Строка {d} пустая.|Zamówienie {d} jest gotowe.|Sipariş {d} hazır.|Παραγγελία {d} έτοιμη.|订单 {d} 已发货。|版本 {d} 已发布。|注文 {d} は発送済みです。|行 {d} は空です。
We wrote it down and went on.|Nothing else reads the file.|It was late, so the queue grew.|Then the cache was cold.|Thanks for the quick reply!|Regards to the team.|Dear all, the window is on Sunday.|Hi there, is it up?|Name the file after the table.|Contact support before noon.|Ask the vendor.|Author unknown.|by the way, it works|from {w} to {w}|with {w} it is faster|name: {w}|owner: {v}|{w}: {d}|INFO Nothing to load|ERROR {w} failed|WARN {w} is slow|INFO Loaded {d} rows|DEBUG Retry {d}|LIMIT {d} ROWS {d} BATCH {d}|total, err := load({d})|{w}, {w} and {w}
""".replace("{{x}}", "{x}")

_PHONES = """+1 (999) 999-9999|+1-999-999-9999|+19999999999|+1 999 999 9999|(999) 999-9999|999-999-9999|999.999.9999|(999) 999 9999|999-9999|999 9999|+44 7999 999999|+44 20 9999 9999|020 9999 9999|07999 999999|07999 999 999|+49 999 9999999|+49 99 99999999|0999 9999999|0999/999999|0999-9999999|+49 (0)99 999999
+33 9 99 99 99 99|09 99 99 99 99|09.99.99.99.99|+34 999 999 999|999 99 99 99|699 999 999|+351 999 999 999|+55 99 99999-9999|(99) 99999-9999|+7 999 999-99-99|8 (999) 999-99-99|+48 999 999 999|+90 999 999 99 99|0999 999 99 99|+30 999 999 9999|+86 199 9999 9999|199 9999 9999|19999999999|+81 99-9999-9999|099-9999-9999|03-9999-9999|+91 99999 99999|0099 99 9999999|00 99 999 999 999|+999 99 999 9999|tel:+19999999999|tel:+1-999-999-9999|+9999999999999""".replace("\n", "|").split("|")
_IDS = """999-99-9999|999 99 9999|99-9999999|AA999999A|AA 99 99 99 A|A9999999|AA9999999|A99999999|999999999|99AA99999|A9AA99A99|99999999A|A9999999A|999.999.999-99|99.999.999-9|99 999 999 999|99999999999|9999 999999|99 99 999999|999999 9999|999-999-999 99|99999999999|999999-9999999|999999999999999999|99999999999999999A|9999-9999-9999|9999 9999 9999|A999-9999-9999
A9999999-9|A999999999999|AAAA9999999|AAAAA999999AA9AA|9 99 99 99 999 999 99|99.99.99-999.99|AA 999999|A-9999999|999 999 999|999999999A|9999999A""".replace("\n", "|").split("|")
_OTHER = """9999|99999|999999|9999999|99999999|999999999|9999999999|17999999999|1799999999999|1799999999|9.99.9|9.9.99-rc.9|99.99.9999|9999-99-99|99/99/9999|99.99.99.99|999.999.9.99|127.0.0.1|9,999,999|999.999|9 999 999|99:99:99|9999-9999|9999-9999-9999|999-9999-9999|99-99-99|A999|A-9999|AAA-9999|9.9e-9|0x99999999|99 of 99|978-9-99-999999-9|99999-99999|999-99|9999.9999.9|9999 9999""".replace("\n", "|").split("|")
_STREETS = {
    "en": "9 {n} Street|99 {n} St.|999 {n} Avenue|99 {n} Ave, Apt 9|9999 {n} Road|99 {n} Rd.|9A {n} Lane|99 North {n} Drive|999 {n} Boulevard, Suite 99|99 {n} Court, {c} 99999|Flat 9, 99 {n} Road|Apt 9, 99 {n} Street|99 {n} {c} Street, {c}|9 The {n} Crescent|99 Old {n} Way|999 {n} Street, {c}, 99999|99 {n} Lane, {c} 9999|12-14 {n} Place|99 St. {n} Road|Unit 9, 99 {n} Close|Flat 9, 99 {n} Road, {c} 99999|Apartment 99, 9 {n} Lane, {c}|Suite 999, 9999 {n} Avenue, {c}, 99999",
    "de": "{n}straße 99|{n}straße 9, 99999 {c}|{n}weg 9|{n}gasse 9a|{n}platz 9|{n}allee 99, 9999 {c}|Alte {n}straße 9|{n}er Straße 99|{n}str. 9|Am {n}platz 9|{n}straße 99, {c}",
    "fr": "99 rue de {n}|9 rue {n}, 99999 {c}|99 avenue {n}|9 bis rue du {n}|99, boulevard {n}|9 place de la {n}|99 chemin des {n}|9, allée {n}, 99999 {c}",
    "es": "Calle {n} 99|calle de {n}, 9|Avenida {n} 999, 9º B|Plaza de la {n} 9|Calle {n} 9, 99999 {c}|Paseo {n} 99|Avenida de {n}, 9",
    "pt": "Rua {n} 99|Rua de {n}, 999|Avenida {n}, 999|Praça da {n}, 9|Travessa {n} 9|Rua {n} 99, {c}|Rua das {n} 9, 9 andar",
    "ru": "ул. {n}, 99|улица {n}, 9|ул. {n}, д. 9, кв. 99|проспект {n}, 99|пер. {n} 9",
    "pl": "ul. {n} 99|ul. {n} 9/99|ulica {n} 9 m. 9|al. {n} 99|pl. {n} 9, 99-999 {c}|ul. {n} {c} 99",
    "tr": "{n} Sokak No 99|{n} Caddesi 99|{n} Cad. No: 9|{n} Sok. 9, {c}|{n} Mahallesi, {c} Sokak 9",
    "el": "οδός {n} 99|Λεωφόρος {n} 99|οδός {n} 9, {c}|Πλατεία {n} 9",
}
_GREEK = str.maketrans(dict(zip("abdefgiklmnoprstuvzh", "αβδεφγικλμνοπρστυβζη", strict=True)))
_CYRILLIC = str.maketrans(dict(zip("abdefgiklmnoprstuvzh", "абдефгиклмнопрстувзх", strict=True)))


def training_examples(names: list[tuple[str, str]], count: int = 3600, seed: int = 11, templates: list[tuple[str, str]] | None = None) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, spans) by the templates, joined to texts of one to three sentences.

    `templates` are (language, template) to use instead, for held-out sentences.
    """
    r = random.Random(seed)
    given = [n for n, k in names if k == "given"] or ["Ada"]
    family = [n for n, k in names if k == "family"] or ["Lovelace"]
    having = [(lang, t) for lang, ts in _WITH.items() for t in (x for line in ts.strip("\n").split("\n") for x in line.split("|")) if t]
    having = [(lang, t.translate(_SIGNS)) for lang, t in having]
    without = [t.translate(_SIGNS) for line in _WITHOUT.strip().split("\n") for t in line.split("|") if t]
    per_lang = {lang: [t for k, t in having if k == lang] for lang in _WITH}

    def strange(lang: str = "en") -> str:  # a word of no language
        s = "".join(r.choice("bdfgklmnprstvzh") + r.choice("aeiou") + r.choice(["", "", "n", "r", "l", "s"]) for _ in range(r.randint(2, 3)))
        s = s.translate(_CYRILLIC) if lang == "ru" else s.translate(_GREEK) if lang == "el" else s
        return s.capitalize()

    def mixed(pool: list[str]) -> str:  # an unlisted name with a listed ending
        a, b = r.choice(pool), r.choice(pool)
        return a[: max(2, len(a) // 2)] + b[len(b) // 2 :].lower()

    def pick(pool: list[str], lang: str) -> str:
        x = r.random()
        return r.choice(pool) if x < 0.7 else mixed(pool) if x < 0.88 else strange(lang if lang in ("ru", "el") and r.random() < 0.6 else "en")

    def digits(form: str, letters: bool = True) -> str:
        return "".join(str(r.randint(0, 9)) if c == "9" else r.choice("ABCDEFGHJKLMNPRSTXYZ") if letters and c == "A" else c for c in form)

    def person(lang: str) -> str:
        g, f, x = pick(given, lang), pick(family, lang), r.random()
        if r.random() < 0.2:  # both unlisted
            g, f = strange(lang if r.random() < 0.6 else "en"), strange(lang if r.random() < 0.6 else "en")
        if lang in ("zh", "ja") and x < 0.3:
            n = r.choice("王李张刘陈杨赵黄周吴佐鈴高田伊") + "".join(r.choice("伟芳娜敏静强磊洋勇艳子郎介香樹木藤山田") for _ in range(r.randint(1, 2)))
            return n
        if x < 0.08:
            return f"{f}, {g}"
        if x < 0.2:
            return f"{r.choice(['Dr.', 'Dr', 'Ms', 'Mr.', 'Mrs', 'Prof.', 'Mr', 'Ms.'])} {r.choice([f, f'{g} {f}'])}"
        if x < 0.26:
            return f"{g[0]}. {f}"
        if x < 0.3:
            return f"{g} {g[0]}. {f}"
        if x < 0.34:
            return f"{g} {r.choice(['de', 'van', 'von', 'da'])} {f}"
        if x < 0.4:
            return g
        s = f"{g} {f}"
        y = r.random()
        return s.upper() if y < 0.07 else s.lower() if y < 0.18 and (g in given or f in family) else s

    def street(lang: str) -> str:
        lang = lang if lang in _STREETS else r.choice(list(_STREETS)) if r.random() < 0.4 else "en"
        if r.random() < 0.45:
            lang = r.choice(list(_STREETS))
        n = r.choice(family) if r.random() < 0.5 else strange(lang)
        s = digits(r.choice(_STREETS[lang].split("|")), letters=False).replace("{n}", n if lang != "pl" or r.random() < 0.5 else n + "a").replace("{c}", strange(lang) if r.random() < 0.6 else r.choice(family))
        s = re.sub(r"\b0+(?=\d)", "", s)
        return s.lower() if r.random() < 0.18 and lang == "en" else s

    def east_street(lang: str) -> str:
        a = lambda k: "".join(r.choice("东西南北中和平建国人民长安新华文化光明青山") for _ in range(k))
        if lang == "zh":
            return r.choice(["", a(2) + "市", a(2) + "市" + a(2) + "区", a(2) + "区"]) + a(r.randint(2, 3)) + r.choice(["路", "街", "大道", "巷"]) + str(r.randint(1, 999)) + "号" + r.choice(["", "", "3楼", "402室"])
        return r.choice(["", "東京都", "大阪府"]) + a(2) + r.choice(["区", "市"]) + a(2) + r.choice([f"{r.randint(1, 9)}丁目{r.randint(1, 30)}番{r.randint(1, 20)}号", f"{r.randint(1, 9)}-{r.randint(1, 30)}-{r.randint(1, 20)}", f"町{r.randint(1, 9)}-{r.randint(1, 20)}"])

    def mail() -> str:
        g, f = r.choice(given).lower(), r.choice(family).lower()
        user = r.choice([g, f"{g}.{f}", f"{g[0]}{f}", f"{f}_{r.randint(1, 99)}", f"{g}-{f}", f"{g}+{strange().lower()}", f"{strange().lower()}{r.randint(1, 999)}", f"{f}.{g}.{strange().lower()}"])
        user = "".join(c for c in user if c.isascii()) or "box"
        dom = r.choice(["", "", "mail.", "post.", "eu.corp."]) + strange().lower() + r.choice([".com", ".org", ".net", ".io", ".test", ".example", ".invalid", ".co.uk", ".de"])
        x = r.random()
        at, dot = ("@", ".") if x < 0.8 else r.choice([(" (at) ", "."), ("(at)", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]")])
        return user + at + dom.replace(".", dot)

    def word() -> str:
        return r.choice(["Monday", "Docker", "Linux", "Parser", "Index", "Support", "Berlin", "Archive", "Window", "Query", "Makefile", "Kernel", "Schema", "Finance", "Readme", "Warehouse", "Summary", "Backup", "Python", "October", "Upload", "Gateway", "Budget", "Lisbon", "Turbine", "Notebook", "Harbour", "Pipeline", "Overview", "Installation", "Changes"])

    def fill(lang: str, template: str) -> tuple[str, list[tuple[int, int, str]]]:
        text, gold, at = "", [], 0
        for m in _SLOT.finditer(template):
            text += template[at : m.start()]
            at, k = m.end(), m[1]
            v = (
                person(lang) if k == "p" else digits(r.choice(_PHONES)) if k == "t" else mail() if k == "e" else (east_street(lang) if lang in ("zh", "ja") and r.random() < 0.6 else street(lang)) if k == "s" else digits(r.choice(_IDS)) if k == "i" else digits(r.choice(_OTHER)) if k == "d"
                else word() if k == "w" else (r.choice(given) if r.random() < 0.5 else r.choice(given).lower()) if k == "g" else f"code.{strange().lower()}.{r.choice(['com', 'org', 'example'])}" if k == "h" else r.choice(["left-pad", "lodash", "cached", "route", "loader", "worker", "fixture"]) if k == "v" else digits("9.9.9") if k == "n" else "x"
            )
            if k in _KIND:
                gold.append((len(text), len(text) + len(v), _KIND[k]))
            text += v
        return text + template[at:], gold

    out = []
    langs = list(_WITH)
    for _ in range(count):
        lang = "en" if r.random() < 0.5 else r.choice(langs)
        text, gold = "", []
        for _ in range(r.choice([1, 1, 2, 3])):
            if templates:
                s, g = fill(*r.choice(templates))
            elif r.random() < 0.45:
                s, g = fill(lang, r.choice(without))
                s = s.title() if r.random() < 0.1 else s
            else:
                s, g = fill(lang, r.choice(per_lang[lang]))
            if text:
                text += r.choice([" ", " ", "\n", "\n\n"]) if lang not in ("zh", "ja") or s[:1].isascii() else r.choice(["", "\n"])
            gold += [(a + len(text), b + len(text), k) for a, b, k in g]
            text += s
        out.append((text, gold))
    return out
