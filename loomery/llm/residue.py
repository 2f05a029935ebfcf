"""Template residue, filler, error and script-demand messages that stand where a title should.

A multi-pattern automaton (Aho-Corasick) scans each text once, lower case and with one blank between
words. Marks of unfilled placeholders are confirmed by an exact pattern and count wherever they
stand; phrases of messages and filler count when they cover most of the text's letters, captions such as
"Chapter" and numbers not counted. So a work that merely uses such a word stays.

Defined results: null, empty and blank texts are no residue; repeated rows get equal answers; very
long texts are scanned whole in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Share of a text's letters that phrases must cover.
COVERAGE = 0.75

MESSAGES = """
page not found|file not found|not found|bad gateway|forbidden|access denied|access forbidden|permission denied|unauthorized|internal server error|server error|service unavailable|service temporarily unavailable|gateway timeout|gateway time-out|request timeout|request timed out|connection refused by upstream|connection refused|connection reset by peer|connection reset|the connection has timed out|connection timed out|too many requests, slow down|too many requests|rate limit exceeded|slow down|request failed with status code|request failed|http error|http status|http|error code|error|fatal error|status code|see the log|error on this server|on this server|the proxy answered with|oops! something went wrong|something went wrong|an error occurred|an unexpected error occurred|unexpected error|please try again later|try again later|this page does not exist|the page you requested could not be found|page does not exist|page unavailable|this domain is parked|domain is parked|this domain is for sale|domain for sale|parked domain|account suspended|this account has been suspended|site suspended|under construction|coming soon|site under maintenance|under maintenance|maintenance mode|be right back
just a moment|checking your browser|checking your browser before accessing|attention required! please verify you are human|attention required|please verify you are human|verify you are human|are you a robot|i'm not a robot|complete the captcha|captcha|one moment, please|please wait|redirecting|you are being redirected|loading|loading, please wait|now loading|page loading|please stand by
please enable javascript to continue|please enable javascript to view this page|please enable javascript|enable javascript to continue|enable javascript|you need to enable javascript to run this app|javascript is required|javascript is disabled|javascript required|this site requires javascript|this site requires cookies and scripts|this site requires cookies|please enable cookies|enable cookies|your browser does not support scripts|your browser does not support javascript|your browser is not supported|unsupported browser|please turn on javascript|please update your browser|please disable your ad blocker|disable your ad blocker
untitled document|untitled page|untitled|insert title here|your title here|title goes here|sample title goes here|sample title|sample text|your text here|text goes here|placeholder title|placeholder text|placeholder|title placeholder|lorem ipsum dolor sit amet|lorem ipsum|dolor sit amet|consectetur adipiscing elit|new page|default title|page title|document title|todo|tbd|test title|hello world|n/a
typeerror: cannot read properties of undefined|typeerror: cannot read property of undefined|typeerror|referenceerror|syntaxerror|nullpointerexception|uncaught exception|undefined index|undefined variable|undefined is not a function|warning: undefined array key|warning: undefined variable|fatal error: uncaught|on line|stack trace|traceback (most recent call last)|segmentation fault|database error|error establishing a database connection|cannot connect to database|code
页面不存在|您访问的页面走丢了|您访问的页面不存在|访问的页面不存在|页面走丢了|找不到页面|找不到网页|该章节已被删除或不存在|该章节已被删除|章节不存在|内容不存在|该内容已被删除|页面已删除|抱歉，服务器出错了|服务器出错了|服务器错误|服务器内部错误|内部服务器错误|系统繁忙，请稍后再试|系统繁忙|请稍后再试|请稍后重试|访问过于频繁，请稍后重试|访问过于频繁|访问被拒绝|禁止访问|网络错误|请求失败|请求超时|出错了|正在加载中，请稍候|正在加载中|正在加载|加载中|请稍候|加载失败|章节加载失败，请刷新重试|章节加载失败|请刷新重试|您的浏览器不支持脚本|浏览器不支持脚本|请启用javascript后继续浏览|请启用javascript|请开启javascript|请启用脚本|请启用cookie|请输入验证码|安全验证|标题占位文字|占位文字|占位符|此处填写标题|在此输入标题|示例标题|无标题文档|无标题|未命名|测试标题|网站维护中|账号已被停用|域名出售|抱歉|错误
頁面不存在|找不到網頁|找不到頁面|您訪問的頁面不存在|該章節已被刪除或不存在|該章節已被刪除|伺服器發生錯誤|伺服器錯誤|伺服器內部錯誤|系統繁忙，請稍後再試|系統繁忙|請稍後再試|請稍後重試|存取被拒|禁止訪問|載入中，請稍候|載入中|請稍候|載入失敗|正在載入|請啟用javascript以繼續|請啟用javascript|請開啟javascript|您的瀏覽器不支援指令碼|瀏覽器不支援|標題佔位文字|佔位文字|在此輸入標題|範例標題|未命名|無標題|請重新整理|網站維護中|抱歉
ページが見つかりません|お探しのページは見つかりません|お探しのページは見つかりませんでした|サーバーエラーが発生しました|サーバーエラー|内部サーバーエラー|エラーが発生しました|アクセスが拒否されました|アクセス拒否|アクセスが集中しています|しばらくしてから再度お試しください|読み込み中です|読み込み中|ロード中|少々お待ちください|しばらくお待ちください|javascriptを有効にしてください|javascriptが無効です|スクリプトを有効にしてください|cookieを有効にしてください|お使いのブラウザはサポートされていません|ここにタイトルが入ります|タイトルを入力|ここにテキストが入ります|タイトル未設定|無題のドキュメント|無題|サンプルタイトル|ダミーテキスト|メンテナンス中
페이지를 찾을 수 없습니다|요청하신 페이지를 찾을 수 없습니다|서버 오류가 발생했습니다|서버 오류|내부 서버 오류|오류가 발생했습니다|접근이 거부되었습니다|접근 거부|잠시 후 다시 시도해 주세요|요청이 너무 많습니다|로딩 중입니다|로딩 중|로딩중|불러오는 중입니다|불러오는 중|잠시만 기다려 주세요|자바스크립트를 켜 주세요|자바스크립트를 활성화해 주세요|자바스크립트를 사용하도록 설정하세요|자바스크립트|스크립트를 허용해 주세요|쿠키를 허용해 주세요|브라우저가 지원되지 않습니다|여기에 제목을 입력하세요|제목을 입력하세요|제목 없음|예시 제목|점검 중입니다
página no encontrada|no se encontró la página|se produjo un error en el servidor|error interno del servidor|error del servidor|se produjo un error|ha ocurrido un error|acceso denegado|demasiadas solicitudes|inténtelo de nuevo más tarde|servicio no disponible|cargando|cargando, espere|espere por favor|activa javascript para continuar|activa javascript|habilite javascript|active javascript|tu navegador no admite scripts|título de ejemplo|titulo de ejemplo|inserte el título aquí|texto de ejemplo|sin título|su título aquí|en mantenimiento|cuenta suspendida
page introuvable|page non trouvée|la page demandée est introuvable|erreur interne du serveur|erreur du serveur|erreur serveur|une erreur est survenue|une erreur s'est produite|accès refusé|accès interdit|trop de requêtes|service indisponible|réessayez plus tard|chargement en cours|chargement|veuillez patienter|veuillez activer javascript|activez javascript|javascript est désactivé|votre navigateur ne prend pas en charge les scripts|votre titre ici|titre de l'exemple|insérez le titre ici|votre texte ici|sans titre|document sans titre|site en maintenance|compte suspendu
seite nicht gefunden|die seite wurde nicht gefunden|interner serverfehler|serverfehler|ein fehler ist aufgetreten|zugriff verweigert|zu viele anfragen|dienst nicht verfügbar|bitte versuchen sie es später erneut|wird geladen|lädt|bitte warten|bitte aktivieren sie javascript|bitte javascript aktivieren|javascript aktivieren|ihr browser unterstützt keine skripte|hier steht ihr titel|ihr titel hier|hier steht ihr text|titel einfügen|beispieltitel|ohne titel|unbenanntes dokument|wartungsarbeiten|konto gesperrt|diese domain steht zum verkauf
страница не найдена|запрашиваемая страница не найдена|внутренняя ошибка сервера|ошибка сервера|произошла ошибка|что-то пошло не так|доступ запрещён|доступ запрещен|слишком много запросов|сервис недоступен|попробуйте позже|повторите попытку позже|загрузка|идёт загрузка|подождите|пожалуйста, подождите|пожалуйста, включите javascript|включите javascript|ваш браузер не поддерживает скрипты|введите заголовок|здесь будет заголовок|заголовок страницы|пример заголовка|без названия|текст-заполнитель|сайт на обслуживании|аккаунт заблокирован
seite konnte nicht gefunden werden|die seite konnte nicht gefunden werden|diese seite existiert nicht|diese seite existiert nicht mehr|ihre sitzung ist abgelaufen|sitzung abgelaufen|cette page n'existe plus|cette page n'existe pas|page inexistante|votre session a expiré|session expirée|esta página no existe|esta página ya no existe|la página no existe|su sesión ha expirado|sesión caducada|эта страница не существует|страница не существует|сеанс истёк|ваша сессия истекла|your session has expired|session expired|this page no longer exists|this content is no longer available|content unavailable|会话已过期|登录已过期|工作階段已過期|セッションの有効期限が切れました|세션이 만료되었습니다
página não encontrada|a página não foi encontrada|erro interno do servidor|erro no servidor|ocorreu um erro|acesso negado|tente novamente mais tarde|carregando|aguarde|ative o javascript para continuar|ative o javascript|sem título|sessão expirada|sua sessão expirou|em manutenção|este domínio está à venda
pagina non trovata|la pagina non è stata trovata|errore interno del server|errore del server|si è verificato un errore|accesso negato|riprova più tardi|caricamento in corso|caricamento|attendere prego|attiva javascript per continuare|attiva javascript|abilita javascript|senza titolo|sessione scaduta|in manutenzione|dominio in vendita
pagina niet gevonden|interne serverfout|serverfout|er is een fout opgetreden|toegang geweigerd|probeer het later opnieuw|laden|even geduld|schakel javascript in om verder te gaan|schakel javascript in|zonder titel|sessie verlopen|sidan hittades inte|serverfel|ett fel inträffade|åtkomst nekad|aktivera javascript|namnlös|siden ble ikke funnet|siden blev ikke fundet|sivua ei löydy
strona nie została znaleziona|nie znaleziono strony|błąd serwera|wewnętrzny błąd serwera|wystąpił błąd|odmowa dostępu|brak dostępu|spróbuj ponownie później|ładowanie|proszę czekać|włącz javascript, aby kontynuować|włącz javascript|bez tytułu|sesja wygasła|stránka nenalezena|chyba serveru|přístup odepřen|načítání|az oldal nem található|pagina nu a fost găsită|eroare de server|acces interzis
sayfa bulunamadı|aradığınız sayfa bulunamadı|sunucu hatası|bir hata oluştu|erişim engellendi|erişim reddedildi|lütfen daha sonra tekrar deneyin|yükleniyor|lütfen bekleyin|devam etmek için javascript'i etkinleştirin|lütfen javascript'i etkinleştirin|javascript'i etkinleştirin|başlıksız|oturumunuzun süresi doldu|bakım çalışması
không tìm thấy trang|trang không tồn tại|lỗi máy chủ|đã xảy ra lỗi|truy cập bị từ chối|vui lòng thử lại sau|đang tải|vui lòng chờ|vui lòng bật javascript để tiếp tục|vui lòng bật javascript|hãy bật javascript|không có tiêu đề|phiên đã hết hạn|đang bảo trì
halaman tidak ditemukan|kesalahan server|terjadi kesalahan|akses ditolak|coba lagi nanti|memuat|harap tunggu|aktifkan javascript untuk melanjutkan|aktifkan javascript|tanpa judul|sesi berakhir
сторінку не знайдено|помилка сервера|сталася помилка|доступ заборонено|спробуйте пізніше|завантаження|зачекайте|увімкніть javascript|без назви|η σελίδα δεν βρέθηκε|σφάλμα διακομιστή|δεν επιτρέπεται η πρόσβαση|φόρτωση|ενεργοποιήστε τη javascript|الصفحة غير موجودة|خطأ في الخادم|حدث خطأ|تم رفض الوصول|جار التحميل|يرجى تفعيل جافا سكريبت|הדף לא נמצא|שגיאת שרת|גישה נדחתה|טוען|ไม่พบหน้านี้|เกิดข้อผิดพลาด|กำลังโหลด|โปรดเปิดใช้งาน javascript|पृष्ठ नहीं मिला|सर्वर त्रुटि|लोड हो रहा है
""".strip().replace("\n", "|").split("|")
#: Values that no one set; they count alone or behind a caption.
UNSET = ["[object object]", "undefined", "null", "nan", "(null)", "none", "nil", "nullptr", "#n/a", "#ref!", "#value!", "#name?"]
#: Words of captions: neither part of a message nor of anything else.
CAPTIONS = ["chapter", "chap.", "ch.", "episode", "ep.", "volume", "vol.", "part", "no.", "read", "kapitel", "folge", "lesen", "chapitre", "épisode", "lire le", "capítulo", "episodio", "leer el", "глава", "серия", "читать", "главу", "第", "话", "話", "章", "回", "제", "화", "title", "name"]

#: Of any length; no alternative can run over another start of itself, so a search takes linear time.
PLACEHOLDER = re.compile(
    r"""\{\{[^{}]*\}\}|\{%[^%]*%\}|\{\#[^#{}]*\#\}|\$\{[^{}]*\}|\#\{[^{}]*\}|\{[A-Za-z_][\w.\-\[\]]*\}|\{\d{0,3}\}|<\?(?:php|=)
    |\[\[[\w.\-|\s]+\]\]|%\([A-Za-z_]\w*\)[sdifr]|%[A-Z][A-Z0-9_]{2,}%|\$\$[A-Za-z_]\w*\$\$|__[A-Z][A-Z0-9_]+__|(?<![\w:/]):[A-Za-z_]\w*:(?![\w:/])|(?<![\w.@])@(?:Model|Html|ViewBag|ViewData|model)\b[\w.\[\]"]*|(?<![\w%])%(?:\d+\$)?[sd](?!\w)|<(?:title|name|chapter)(?:_\w+)?>|\{\$[\w.>\-]+\}|<<[A-Za-z_]\w*>>|\$[A-Za-z_]+(?:->|\.)\w+|\#\#[A-Z_]+\#\#|~[A-Z_]{3,}~""",
    re.X | re.S,
)
#: Placeholders that hold anything between two marks.
BETWEEN = [("<%", "%>"), ("&lt;%", "%&gt;"), ("&lt;?", "?&gt;"), ("<#", "#>")]
#: What every placeholder holds somewhere.
MARKS = ["{", "${", "<%", "&lt;", "<?", "[[", "%(", "%", "$$", "__", ":", "@", "<", "$", "##", "~"]
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = re.compile(r"\s+")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in ((0, MARKS), (3, CAPTIONS), (2, UNSET), (1, MESSAGES)):
        for w in words:
            if w.strip():
                a.add_word(w.strip(), (kind, len(w.strip())))
    a.make_automaton()
    return a


def residue(text: str | None) -> str | None:
    """'placeholder', 'unset' or 'message', or None for real content."""
    if not text or text.isspace():
        return None
    low = _BLANK.sub(" ", text.strip()).lower()
    spans: list[tuple[int, int, int]] = []
    mark = False
    for end, (kind, size) in automaton().iter(low):
        if kind == 0:
            mark = True
        else:
            a, b = end + 1 - size, end + 1
            # a Latin, Cyrillic or Hangul word counts only as a whole
            if (a and low[a].isalpha() and low[a - 1].isalpha() and low[a] < "\u3000" and low[a - 1] < "\u3000") or (b < len(low) and low[b - 1].isalpha() and low[b].isalpha() and low[b - 1] < "\u3000" and low[b] < "\u3000"):
                continue
            spans.append((a, b, kind))
    if mark and (PLACEHOLDER.search(text) or any((at := text.find(a)) >= 0 and text.find(b, at + len(a)) >= 0 for a, b in BETWEEN)):
        return "placeholder"
    if not any(k in (1, 2) for _, _, k in spans):
        return None
    cover = bytearray(len(low))
    for kind in (3, 2, 1):
        for a, b, k in spans:
            if k == kind:
                cover[a:b] = bytes([kind]) * (b - a)
    total = hit = unset = 0
    for c, k in zip(low, cover):
        if _LETTER.match(c) and k != 3:
            total += 1
            hit += k == 1
            unset += k == 2
    if total and (hit + unset) / total >= COVERAGE:
        return "unset" if unset > hit else "message"
    return None


def find(df: DataFrame) -> DataFrame:
    """df(audit_id, field, text) → (audit_id, field, kind) of the residue."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, str | None] = {}
        for batch in batches:
            at, kinds = [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                k = seen.get(t, 0)
                if k == 0:
                    k = residue(t)
                    if len(seen) < 20000 and len(t) < 200:  # most captions recur
                        seen[t] = k
                if k:
                    at.append(i)
                    kinds.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string())], names=["audit_id", "field", "kind"])

    return df.select("audit_id", "field", "text").where("text is not null and text <> ''").mapInArrow(work, "audit_id bigint, field string, kind string")
