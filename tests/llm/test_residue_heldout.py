"""Recall and precision on texts that were written apart from the exemplars and share no sentence with them."""

from collections import Counter

from callweave.llm import residue as R

RESIDUE = [
    "Error 404\nThe requested page could not be found on this server.",
    "Service temporarily unavailable\nOur server is overloaded at the moment. Please come back and try again in a few hours.",
    "Sorry! We can't find that page. It may have been deleted or moved to another address.",
    "Internal server error. An unexpected error occurred while the page was being processed.",
    "You do not have permission to view this page. Please log in and try again.",
    "Your IP address has been blocked because of unusual traffic. Please complete the captcha to continue.",
    "Please turn JavaScript on in your browser settings and reload this page.",
    "This application requires JavaScript. Enable it to continue.",
    "We are down for maintenance. We will be back soon. Thanks for your patience!",
    "Database error: could not connect to server on line 7 of index.php",
    "The connection timed out. The server took too long to respond.",
    "Gateway error: the upstream server returned an invalid response.",
    "Access to this resource is forbidden.",
    "Your session expired. Sign in again to continue.",
    "Diese Seite existiert leider nicht mehr. Bitte überprüfen Sie die Adresse.",
    "Interner Fehler. Bitte versuchen Sie es später noch einmal.",
    "La page demandée est introuvable. Veuillez vérifier l'adresse ou réessayer plus tard.",
    "Error interno en el servidor. Inténtelo de nuevo en unos minutos.",
    "ページが存在しません。URLをご確認ください。",
    "JavaScriptが無効です。ブラウザの設定で有効にしてください。",
    "Dear {{ recipient }}, we invite papers on tides.",
    "Submissions on ${topic} close in June.",
    "The editors of [insert journal here] welcome notes.",
    "Papers go to <%= editor.mail %> by May.",
    "Deadline: undefined",
    "The deadline is %DEADLINE% and will not move.",
    "Hello *|LNAME|*, a new call is out.",
    "Topics: [your topics]",
    "Scope of the issue\nLorem ipsum dolor sit amet consectetur.",
    "Your text goes here.",
    "Please replace this sample text before publishing the page.",
    "Dies ist ein Blindtext.",
    "Due date: __________",
]
CONTENT = [
    "Editors of the special issue invite work on memory errors in older pilots. Papers are due on 3 May 2027.",
    "We study how people react when a server does not respond. Reports of user trials are welcome, as are reviews of waiting times in care.",
    "This issue asks what happens when access is denied to readers with low vision, and how libraries can help them find texts.",
    "A call for papers on web archiving: dead links, missing pages and the loss of public records in small towns.",
    "The collection gathers studies on JavaScript frameworks in teaching. Authors should send an abstract of 300 words to the editors.",
    "The workshop is about robots that ask for help. Humans and robots will share a kitchen for three days.",
    "Scripts for plays and films by nurses are welcome; readings will be held in Leeds.",
    "Guest editors: A. Ray and B. Cloud. The journal covers security, firewalls and attacks on hospitals.",
    "Please contact the editors with any question. Manuscripts are reviewed within six weeks.",
    "In the sample letter the placeholder {{name}} is replaced by the name of the author. We invite work on letters to patients.",
    "Use the notation ${x} for a variable when you write the appendix. The issue is about teaching algebra to adults.",
    "Temperatures [low, high] and masses (see table 3) must be given in SI units. The topic is the physiology of cold.",
    "We welcome work on placeholder selection in statistical tables and on null results in psychology.",
    "The deadline has been extended to 4 June 2027. Please submit through the site of the journal.",
    "Die Zeitschrift lädt zu Beiträgen über Fehlerkultur in Kliniken ein. Einsendeschluss ist der 3. Mai 2027.",
    "La revue lance un appel sur les erreurs médicales et leur traitement par les équipes de nuit.",
    "El número especial trata de los errores de lectura en personas mayores y de su tratamiento.",
    "本特集では、読書支援ロボットに関する論文を募集します。締切は2027年5月3日です。",
    "Call on maintenance work: bridges, rails and the people who keep them. Photo essays are welcome.",
    "We ask how readers find a page again after a site has moved, and what librarians can do for them. Case studies from small libraries are wanted.\n\nPlease enable cookies for statistics.",
    "Latin in schools: from Cicero to the present day. Contributions on dolor and labor in medical Latin are welcome.",
    "Sleep and error. This issue gathers papers on error rates of tired drivers, of nurses on night shifts and of pilots.",
]
#: What calls usually say; it makes the usual words of calls common.
USUAL = [
    "The deadline for papers has been extended to 5 May 2027. Authors should submit through the online system of the journal.",
    "Please submit abstracts of 250 words to the guest editors by the date above. The site of the journal has a guide for authors.",
    "All manuscripts are reviewed by two readers. Please contact the editors if you have any question about the issue.",
]


def test_recall_and_precision_on_unseen_texts():
    # The corpus is mostly content, so its words are the common ones.
    df = Counter(t for text in (CONTENT + USUAL * 7) * 40 + RESIDUE for t in R.exemplar_tokens().intersection(R.window_tokens(text)))
    index = R.Index(dict(df), 40 * (len(CONTENT) + 7 * len(USUAL)) + len(RESIDUE))
    hits = [R.is_residue(t, index) for t in RESIDUE]
    false = [t for t in CONTENT if R.is_residue(t, index)]
    missed = [t for t, h in zip(RESIDUE, hits, strict=True) if not h]
    assert sum(hits) >= 0.9 * len(RESIDUE), missed
    assert not false, false


def test_no_sentence_is_shared_with_the_index():
    from callweave.llm import exemplars as E

    own = {w.strip().lower() for t in (*E.MESSAGES, *E.FILLERS, *E.SLOTS, *E.STATUS_LINES) for w in R.windows(t)}
    assert not own & {w.strip().lower() for t in RESIDUE + CONTENT for w in R.windows(t)}
