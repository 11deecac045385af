"""Words that mark kinds of personal information, in the languages of the texts (fixed values)."""

from __future__ import annotations


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


PHONE = _words("""
phone tel telephone mobile cell cellphone fax call dial ring text sms whatsapp reach hotline landline
telefon telefonnummer rufnummer handy handynummer mobil mobilnummer anrufen ruf rufen durchwahl
téléphone portable appelle appelez appeler joindre joignable
teléfono telefono móvil celular llama llame llámame llamar
telefone telemóvel ligue liga ligar
телефон телефона тел моб мобильный звони звоните позвони позвоните
komórka komórkowy zadzwoń dzwoń telefonu
telefonum cep arayın arayabilirsiniz
τηλέφωνο τηλ κινητό κάλεσε καλέστε
""")

IDENTITY = _words("""
passport ssn social security tax taxpayer tin national identity identification licence license driver driver's driver’s driving nino insurance
reisepass reisepassnummer pass ausweis personalausweis ausweisnummer steuer-id steuernummer steueridentifikationsnummer führerschein sozialversicherungsnummer
passeport identité permis fiscal sécurité sociale
pasaporte dni nie nif cédula licencia curp identidad
passaporte cpf cartão contribuinte rg carteira identidade habilitação
паспорт паспорта инн снилс удостоверение удостоверения
paszport paszportu pesel dowód dowodu nip
pasaport kimlik ehliyet vergi
διαβατήριο διαβατηρίου ταυτότητα ταυτότητας αφμ αμκα
""")

COUNTED = _words("""
order build version release rev revision ticket issue case invoice commit checksum digest hash epoch timestamp serial sku isbn port pid line lines row rows job run batch part item
sequence offset bytes size count total page step shipment tracking reference ref model device request trace account-less code sensor chapter
bestellung bestellnummer auftrag zeile zeilen rechnung vorgang seriennummer
commande facture ligne lignes dossier
pedido factura línea fila encomenda fatura linha
заказ заказа строка строк версия сборка счёт
zamówienie zamówienia wersja wiersz faktura
sipariş sürüm satır fatura
παραγγελία παραγγελίας έκδοση γραμμή
""")

PLACE = _words("""
address live lives living lived reside resides residing home ship shipped deliver delivered located visit office parcel post moved
adresse anschrift wohne wohnt wohnhaft zuhause
habite habitons domicile demeure livrer
dirección vivo vive domicilio envíe
endereço morada moro mora entregue
адрес адресу живу живёт живет проживает доставьте
adres adresu mieszkam mieszka
adresim adresi oturuyorum ikamet
διεύθυνση μένω μένει κατοικώ
""")

PERSON = _words("""
name named contact dear hi hello hey regards sincerely cheers author authored owner assignee assigned reviewer reviewed approved signed patient attendee attendees participants
cc ask asked told tell met meet meeting thanks thank speaker manager colleague customer client employee recipient guest nurse tenant applicant
heiße heisse heißt gruß grüße grüßen kontakt liebe lieber kollegin kollege ansprechpartner
appelle nom prénom cher chère cordialement collègue
llamo llama nombre apellido contacto hola estimado estimada querido querida saludos
chamo nome contato olá caro cara abraço
зовут имя фамилия уважаемый уважаемая контакт здравствуйте коллега
nazywam imię nazwisko drogi droga pozdrawiam
adım adı ismim sayın sevgili
λέγομαι όνομα ονομάζομαι λένε αγαπητέ αγαπητή
""")

#: Words that are followed by a name more than by anything else.
NAMING = _words("name named heiße heisse heißt appelle nom llamo llama nombre chamo nome зовут имя nazywam imię nazwisko adım ismim λέγομαι ονομάζομαι όνομα λένε dear mr mrs")
TITLES = _words("dr mr mrs ms miss mx prof sir madam herr frau mme m mlle monsieur madame sr sra srta don doña dona dom pan pani bay bayan г-н г-жа госпожа господин κ κα κύριε κυρία")
PARTICLES = _words("de da do dos das del la le van von der den di du bin al el y e ten ter zu")

STREETS = _words("""
street st avenue ave road rd lane ln court ct drive dr boulevard blvd place square terrace close crescent way highway parkway walk gardens grove mews
calle avenida av avda plaza paseo camino carrera carretera
rua praça largo alameda estrada travessa
rue quai chemin allée impasse
ul ulica aleja al plac osiedle
улица ул проспект пр-т просп переулок пер шоссе бульвар наб набережная площадь
sokak sok cadde caddesi cad bulvarı mahallesi mah sokağı
οδός λεωφόρος λεωφ πλατεία
straße strasse str gasse weg platz allee
""")
STREET_ENDS = ("straße", "strasse", "str", "gasse", "weg", "platz", "allee")
#: Parts of a building.
UNITS = _words("apt apartment unit suite flat floor room no nr n piso puerta apto andar étage bât bâtiment wohnung stock кв д дом корпус корп m mieszkanie daire kat διαμ όροφος")

#: Frequent words that begin sentences and are no names.
COMMON = _words("""
the a an this that these those it its he she we they you i my our your their his her and or but if when while after before because since there here what which who how why where then now also not no yes
in on at to for from of with without by as is are was were be do does did can could should would will may might must have has had let please just only some any all each every both most more next last first second
new old one two three use see run add set get make check note see try open read write move keep send put give take file table error result example step section
der die das ein eine und oder wenn nach ich wir sie es mein meine ist sind war bitte nicht auf mit von für den dem des im am zum zur als wie was
le la les un une et ou si mon ma mes nous vous il elle ce cette est sont était dans pour avec sur pas je les des du au aux
el los las una y o si mi mis es son era en para con sobre no yo nosotros por que se lo al del
um uma os as e ou meu minha são em para com sobre não eu nós por que
и или если мой моя мы вы он она это есть был в на для с по не я как что после
i lub jeśli mój moja my on ona to jest był w na dla z po nie ja jak co
ve veya eğer benim biz o bu bir için ile değil ben
και ή αν μου εμείς αυτό είναι ήταν σε για με δεν εγώ το η ο
""")
