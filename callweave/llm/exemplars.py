"""Labelled exemplars of residue, as public software writes it.

They are the default pages of web servers, proxies, firewalls, frameworks and browsers, the notices of sites that want
scripts, the fillers of page builders and the slots of template languages, written down from general knowledge and not
from any table of this project. Status lines are made from the HTTP status codes of the standard library.
"""

from __future__ import annotations

from http import HTTPStatus

STATUS_LINES = tuple(f"HTTP/1.1 {s.value} {s.phrase}\n{s.description}" for s in HTTPStatus if s >= 400)

# What pages say instead of content.
MESSAGES = (
    "The requested URL was not found on this server. Apache Server at localhost Port 80",
    "You don't have permission to access this resource on this server.",
    "The server encountered an internal error or misconfiguration and was unable to complete your request.",
    "Please contact the server administrator to inform them of the time this error occurred and the actions you performed just before this error.",
    "More information about this error may be available in the server error log.",
    "The server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later.",
    "The proxy server received an invalid response from an upstream server. The gateway did not receive a timely response from the upstream application.",
    "Your browser sent a request that this server could not understand.",
    "This server could not verify that you are authorized to access the document requested.",
    "The resource you are looking for has been removed, had its name changed, or is temporarily unavailable.",
    "An error occurred while processing your request. An unexpected error has occurred. Unhandled exception has occurred in your application.",
    "The website encountered an unexpected error. Please try again in a few minutes.",
    "There has been a critical error on this website. Troubleshooting WordPress.",
    "Error establishing a database connection. Could not connect to the database server.",
    "Briefly unavailable for scheduled maintenance. Check back in a minute. The site is down for maintenance and is expected to be back soon.",
    "We are currently performing maintenance. We are working hard to fix the problem and will be back shortly.",
    "We apologize for the inconvenience. Thank you for your patience. Our team has been notified about the issue.",
    "Sorry, something went wrong. We're having trouble on our end. It's not you, it's us.",
    "Oops, that page can't be found. It looks like nothing was found at this location. Maybe try a search or one of the links below?",
    "Whoops, we ran into a problem. Uh oh, we hit a hitch. Aw, snap!",
    "The page you were looking for doesn't exist. You may have mistyped the address or the page may have moved.",
    "The page you are trying to reach cannot be found. It may have been moved, renamed, removed or deleted.",
    "This page is no longer available. It has been deleted or does not exist any more.",
    "This page isn't available right now. Problem while loading this page. The page could not be loaded.",
    "Failed to load resource. Unable to load the content.",
    "Please check the URL for proper spelling and capitalization. Check the address for typing errors.",
    "Return to the home page. Go back to the previous page, go to the homepage, start over or use the search box to find it.",
    "If the problem persists, please contact the webmaster, the site administrator or support. If you believe this is an error or a mistake, contact us.",
    "Refresh the page or try again later. Reload this page to continue. Please retry in a few seconds. Try again in 5 minutes.",
    "The server is too busy to handle your request. The service is overloaded; please wait a while.",
    "The server is taking too long to respond. The server did not respond in time.",
    "The request timed out. The operation timed out after 30000 milliseconds while waiting for the server.",
    "This site can't be reached. The connection was reset while the page was loading. The connection was refused or closed.",
    "DNS lookup failed. Unable to determine the IP address from the host name. The server IP address could not be found.",
    "curl: (6) Could not resolve host. curl: (52) Empty reply from server. curl: (7) Failed to connect to host",
    "The requested URL could not be retrieved. Your cache administrator is webmaster.",
    "The requested URL was rejected. Please consult with your administrator. Your support ID is: 123456",
    "Error 503 Backend fetch failed. Guru Meditation: XID 12345. Varnish cache server",
    "Request unsuccessful. Incident ID: 123-456. Error code 16. Reference number #18.2f0d. Status code 500. Request ID 7f3a. Error reference: 3c5f",
    "Cloudflare Ray ID: 7d2f3a1c. Your IP: 203.0.113.7. Performance and security by Cloudflare.",
    "Sorry, you have been blocked. You are unable to access this website. This website is using a security service to protect itself from online attacks.",
    "Your request has been blocked by the web application firewall. A firewall rule denied your request.",
    "Access to this page has been denied because we believe you are using automation tools to browse the website.",
    "Your access to this site has been limited by the site owner. Access is forbidden from your network, country or region.",
    "This content is not available in your region. This content is not available in your country.",
    "Our systems have detected unusual traffic from your computer network. Your address is sending automated requests.",
    "You have been rate limited. You have exceeded the limit of requests per hour. Too many requests: slow down and try later.",
    "Verify you are human by completing the action below. Please confirm that you are a human and not a robot.",
    "Please complete the security check to access the site. Solve the captcha or puzzle to continue. Enter the characters you see below.",
    "Checking if the site connection is secure. Checking your browser before accessing. This process is automatic.",
    "Your browser will redirect to your requested content shortly. Please allow up to 5 seconds. Just a moment.",
    "You must be logged in to view this page. Please sign in to continue. You are not authorized to access this page.",
    "Your session has timed out. Session expired, please log in again. This link has expired or is no longer valid.",
    "HTTP Status 500 Internal Server Error: the server encountered an unexpected condition that prevented it from fulfilling the request while rendering",
    "Whitelabel Error Page. This application has no explicit mapping for /error, so you are seeing this as a fallback.",
    "Fatal error: Uncaught Error: Call to undefined function in /var/www/html/index.php on line 12",
    "Warning: mysqli_connect(): Access denied for user 'root'@'localhost' in /var/www/html/db.inc.php on line 34. Cannot connect to database.",
    "Traceback (most recent call last): File \"/srv/app/views.py\", line 12, in render: KeyError: 'title'. jinja2.exceptions.TemplateNotFound: template 'page.html'",
    "Exception in thread \"main\" java.lang.NullPointerException at org.example.Main.main",
    "<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>Error</title></head><body><center><h1>Error</h1></center><hr><center>nginx</center></body></html>",
    "<Error><Code>AccessDenied</Code><Message>Access Denied</Message><RequestId>7A</RequestId></Error>",
    "There is nothing here. This is not the web page you are looking for.",
    "You may not be able to visit this page because of an out-of-date bookmark, a search engine that has an out-of-date listing for this site, or a mistyped address.",
    "An error has occurred while processing your request. If difficulties persist, please contact the System Administrator of this site.",
    "Sorry, the file you have requested does not exist. Make sure that you have the correct URL and the file exists.",
    "Hmm, this page doesn't exist. Try searching for something else. Something went wrong, try reloading.",
    "This content isn't available at the moment. When this happens, it's usually because the owner removed it or only shared it with a small group.",
    "Our CDN was unable to reach our servers. We had to block your request due to a network policy.",
    "Sorry, we just need to make sure you're not a robot. Press and hold to confirm you are a human and not a bot.",
    "There was a problem providing the content you requested. Please contact our support team and provide the details below. Reference number: 5a1c",
    "Page not found. Sorry, the page you requested is unavailable. The link you followed might be broken, outdated, or no longer exist.",
    "Your access has been blocked because you are using an automated process to retrieve content from the site.",
    "Sorry, you are not allowed to access this page. It seems we can't find what you're looking for. Perhaps searching can help.",
    "Application error. An error occurred in the application and your page could not be served. A client-side exception has occurred, see the browser console.",
    "Looks like you've followed a broken link or entered a URL that doesn't exist on this site.",
    "Either the server is overloaded or there is an error in the application. Problem accessing the page. Reason: not found",
    "Sorry, the page you are looking for is currently unavailable. If you are the system administrator of this resource then you should check the error log for details.",
    "You have an error in your SQL syntax. Lost connection to MySQL server during query. Connection to the database failed.",
    "No server is available to handle this request. Unknown domain. Please check that this domain has been added to a service.",
    "Our servers are currently under maintenance or experiencing a technical problem. There is currently no text in this page.",
    "Your account has been suspended. This account has been disabled. The domain has expired. This site is offline or closed.",
    # scripts and cookies
    "Please enable JS and disable any ad blocker. Once this check is complete, the website will open automatically.",
    "Cookies are disabled for this browser. This library requires cookies for authentication and use of other site features.",
    "Please enable JavaScript in your browser to continue using this site. JavaScript must be enabled to view this page.",
    "You need to enable JavaScript to use this application. This app requires scripts to run. It works only with JavaScript turned on.",
    "We're sorry but this app doesn't work properly without JavaScript enabled. Please enable it to continue.",
    "JavaScript seems to be disabled in your browser. JavaScript is turned off or not supported by your browser.",
    "This site requires cookies. Please turn on cookies and JavaScript in your browser settings and reload the page.",
    "Your browser is outdated or not supported and cannot show this website. Please update or upgrade your browser to allow scripts.",
    "Loading, please wait. If nothing happens, your browser may block scripts. If you are not redirected automatically, click here.",
    "<noscript>This page requires JavaScript to be displayed. Scripts are blocked in your browser.</noscript>",
    # German
    "Die Seite wurde nicht gefunden. Die von Ihnen aufgerufene Seite existiert nicht mehr. Die angeforderte Adresse ist nicht vorhanden.",
    "Bitte überprüfen Sie die eingegebene Adresse, die URL oder die Schreibweise.",
    "Es ist ein Fehler aufgetreten. Bitte versuchen Sie es zu einem späteren Zeitpunkt noch einmal. Interner Serverfehler. Fehlercode 500",
    "Die Website ist wegen Wartungsarbeiten vorübergehend nicht erreichbar. Der Dienst ist derzeit nicht verfügbar, der Server ist überlastet.",
    "Der Zugriff auf diese Seite wurde verweigert. Sie haben keine Berechtigung. Ihre Sitzung ist abgelaufen.",
    "Bitte aktivieren Sie JavaScript in Ihrem Browser, um diese Seite zu lesen und alle Funktionen nutzen zu können.",
    "Leider konnten wir die gesuchte Seite nicht finden. Die Webseite kann nicht angezeigt werden. Verbindung fehlgeschlagen, Zeitüberschreitung.",
    "Ihr Browser ist veraltet oder JavaScript ist deaktiviert. Laden Sie die Seite neu. Zurück zur Startseite.",
    # French
    "Page introuvable. La page que vous recherchez ou avez demandée n'existe pas, n'existe plus ou a été déplacée.",
    "Une erreur est survenue. Veuillez réessayer plus tard. Erreur interne du serveur. Merci d'essayer de nouveau dans quelques minutes. Code d'erreur 500",
    "Le site est en maintenance. La page est temporairement inaccessible, le service est momentanément indisponible.",
    "L'accès à cette page vous est refusé. Votre session a expiré.",
    "Veuillez activer JavaScript dans votre navigateur pour afficher cette page et continuer.",
    "Oups, cette page est introuvable. Une erreur s'est produite. Actualisez la page. Retour à la page d'accueil.",
    "JavaScript est désactivé ou votre navigateur n'est pas à jour.",
    # Spanish
    "La página que busca no existe. Página no encontrada; vuelva a la página de inicio o utilice el buscador. El recurso solicitado no fue encontrado.",
    "Se ha producido un error interno. Error del servidor. Por favor, inténtelo de nuevo más tarde o en unos minutos. Código de error 500",
    "El servicio no está disponible temporalmente por mantenimiento.",
    "El acceso a esta página está denegado. Su sesión ha caducado.",
    "Por favor, active JavaScript en su navegador para ver esta página y continuar.",
    "Lo sentimos, no hemos encontrado la página. Ha ocurrido un problema. Recargue la página. Volver a la página principal.",
    "JavaScript está desactivado o su navegador no es compatible.",
    # Italian, Portuguese
    "La pagina richiesta non è stata trovata. Si è verificato un errore, riprova più tardi. Abilita JavaScript nel browser.",
    "A página solicitada não foi encontrada. Ocorreu um erro, tente novamente mais tarde. Ative o JavaScript no navegador.",
    # Japanese, Chinese
    "ページが見つかりませんでした。お探しのページは移動または削除された可能性があります。",
    "指定されたURLのページは存在しません。URLをもう一度お確かめください。ご確認のうえ",
    "エラーが発生しました。しばらくしてから再度お試しください。アクセスが集中しているため、つながりにくくなっています。",
    "ただいまメンテナンス中です。ご迷惑をおかけしております。",
    "アクセスが拒否されました。セッションの有効期限が切れました。",
    "お使いのブラウザではJavaScriptが無効になっています。このサイトを表示するにはJavaScriptを有効に設定してください。",
    "申し訳ございません。ご指定のページは表示できません。時間をおいて再度アクセスしてください。トップページへ戻る。",
    "お使いのブラウザはサポートされていません。通信エラーです。サービスを一時停止しております。サーバーに接続できません。",
    "页面不存在。服务器错误，请稍后再试。请启用JavaScript。",
)
# Filler that stands where content belongs. The first is the classical text, taken as one passage.
LOREM = (
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud"
    " exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla"
    " pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum."
)
FILLERS = (
    "Your content goes here. Edit or remove this text inline.",
    "Put your text here, or type the description of your page here.",
    "Insert a short summary, introduction or caption here before you publish.",
    "I am a text block. Click the edit button to change this text.",
    "This is an example page. Replace this sample paragraph with your own words before publishing.",
    "This is placeholder text, used as dummy copy for the layout only.",
    "Welcome to WordPress. This is your first post. Edit or delete it, then start writing!",
    "The text will follow. Content to follow. Description to come.",
    "bla bla bla, blah di blah",
    "Hier kommt Ihr Text hin. Hier steht dann der Inhalt. Dies ist ein Blindtext oder Platzhalter. Der Text folgt später.",
    "Votre texte ici. Texte de remplissage à remplacer. Texte à compléter, le contenu est à venir.",
    "Escriba aquí su texto. Este es un texto de relleno, un párrafo de muestra o ejemplo.",
    "ここに文章を入力してください。ここにテキストが入ります。本文を入れます。",
    "この文章はダミーです。文字の大きさ、量、字間、行間等を確認するために入れています。",
    "TBD, TBA",
    "testing test",
    "asdf qwer jkl qwerty asdfasdf",
    "xx xxx xxxx xxxxx xxxxxx",
    "foo bar baz qux",
)
# Unfilled slots, one or more for each usual template language and letter template.
SLOTS = (
    "{{ user.name }} {{title}}", "{%block%} {% endif %}", "<%= post.title %> <%name%>", "${name}", "#{name}", "<<FirstName>>", "[[pagetitle]]", "{username}", "__NAME__", "%RECIPIENT%", "$SUBJECT$",
    "@@NAME@@", "@NAME@", "[%name%]", "[[+name]]", "{#name#}", "<#name#>", "<?name>", "{$name}", "*|FNAME|*", "&laquo;AddressBlock&raquo;", "&lt;name&gt;", "##NAME##",
    "[insert your text here] [your name] [enter a title] [add the date] [type the name of the company] [date] [to be confirmed] [TBD] [TBA] [TBC] [put the link here] [fill in the topic] [journal name] [placeholder] [short description] [recipient]"
    " [first name] [last name] [position] [department] [institution] [phone] [website] [time] [location] [venue] [amount] [event] [organization] [editor] [subject] [theme] [number] [year] [month] [deadline]"
    " [issue] [volume] [summary] [abstract] [introduction] [keywords] [details] [more information] [section] [paragraph] [sentence] [image] [address] [city] [country]",
    "<insert your name here> <your title> <enter the date> <name of the company> <email address> <journal name> <topic> <deadline> <to be confirmed> <add text>",
    "(insert your text here) (add the date here) (enter the name here) (type a title here) (put the link here)",
)
# Values that a program printed for want of another, as it writes them.
UNSET = ("undefined", "NaN", "NULL", "[object Object]", "[object Undefined]", "Invalid Date", "Invalid date")
BEFORE_VALUES = ("for", "of", "by", "on", "until", "before", "to", "at", "in", "from", "with", "and", "or", "is", "are", "the", "Dear", "dear", "about", "Deadline", "deadline", "than")
BEHIND_VALUES = ("is", "are", "and", "or", "by", "on", "in", "until", "before", "to", "at", "will", "for", "with", "from", "invites", "welcomes", "words", "days", "papers")
CHROME = (
    "Home | About us | Contact | Journals | Calls | News | Log in",
    "Menu Search Sign in Register Cart",
    "Skip to main content or navigation",
    "Back to top. Start page. Print this page. Share",
    "Copyright 2024. All rights reserved. Terms of use. Privacy policy. Imprint. Editorial office",
)
# How prose speaks of a slot or of filler instead of leaving one.
MENTIONS = (
    "stands for", "is replaced by", "is replaced with", "are replaced by", "will be replaced", "is a placeholder for", "the placeholder", "the variable",
    "notation", "syntax", "merge field", "template language", "such as", "may be used", "for example", "in the format", "the format", "given as", "a value of", "values of",
)
