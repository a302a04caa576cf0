"""Sentences to break answers with: refusals and look-alikes put together from parts, and statements in several languages.

They only train the classifier of ``pairs``; nothing is looked up in them. ``{a|b}`` stands for one of its parts.
"""

from __future__ import annotations

import random
import re

_PART = re.compile(r"\{([^{}]*)\}")


def expand(template: str, rng: random.Random) -> str:
    while (m := _PART.search(template)) is not None:
        template = template[: m.start()] + rng.choice(m[1].split("|")) + template[m.end() :]
    return template


_IT = "{that|this|it|this one|such things}"
_DO = (
    f"{{help|assist|help you|assist you|be of help}} with {{that|this|this request|that topic|this one}}|answer {{that|this|this question|such questions|the prompt}}|{{provide|give|share|offer|disclose}} {{that|this|the requested|any such|those}} {{information|answer|details|content|advice}}|"
    f"{{discuss|comment on|talk about|go into|speak about|elaborate on}} {{this|that|such a}} {{topic|subject|matter|material}}|comply{{ with this request| with that|}}|{{respond|reply}} to {{this|that request|this message}}|"
    f"{{label|classify|judge|rate|assess|evaluate|analyse}} {{this record|this|such content|that text}}|{{continue|proceed|go on}}{{ with this|}}|do {{that|this|so|what you ask}}|say {{more|that|anything about it}}|{{process|handle|fulfil|fulfill|complete|carry out}} {{this|that}} {{request|task|instruction}}|"
    f"{{take part in|engage with|get involved in|be drawn into}} {_IT}|produce {{such an answer|this output|that text}}|generate {{this content|that kind of text}}"
)
_DOING = "helping with that|answering|answering this|giving an opinion on this|discussing this|responding to that|judging this record|sharing such details|continuing"
_NOT = (
    "can't|cannot|can not|can’t|could not|am unable to|am not able to|won't|won’t|will not|won't be able to|am not going to|must decline to|have to decline to|decline to|refuse to|must refuse to|am not permitted to|am not allowed to|"
    "may not|must not|would rather not|do not want to|don't wish to|am unwilling to|am not prepared to|am not in a position to|have been told not to|was instructed not to|am not supposed to|shall not"
)
_I_NOT = f"{{I|I really|I simply|I'm afraid I|I regret that I|Sorry, I|Unfortunately, I|We}} {{{_NOT}}}"
#: Families of refusals; some are kept apart so that thresholds are set on wordings the weights have not seen.
REFUSALS = (
    f"{_I_NOT} {{{_DO}}}",
    f"{{I'm|I am|We are|I’m}} {{sorry|very sorry|afraid|terribly sorry}}{{, but|;|, however,|. But}} I {{{_NOT}}} {{{_DO}}}",
    f"{{As|Being|Since I am}} {{an AI|an AI assistant|a language model|an assistant|an automated system|a chatbot}}, I {{{_NOT}}} {{{_DO}}}",
    f"{{My|Our|The}} {{policy|policies|guidelines|rules|instructions|safety rules|terms}} {{do not|don't|does not|will not}} {{allow|permit|let}} me {{to |}}{{{_DO}}}",
    f"It {{would not be|is not|would be in|wouldn't be}} {{appropriate|right|proper|suitable|responsible|safe}} for me to {{{_DO}}}",
    f"{{I|We}} {{do not feel|don't feel|am not|'m not}} {{comfortable|at ease|happy}} {{{_DOING}}}",
    "{This|That|Your request|What you ask|The question} {is|falls|lies} {outside|beyond} {what I can do|what I am allowed to do|my scope|what I may discuss|my remit|the limits I work under}",
    "{This|That} is {not something|nothing|no question|a request} I {can|am able to|am allowed to|am willing to|will} {do|help with|answer|fulfil|comment on|discuss}",
    "{I apologise|My apologies|Apologies|Sorry|I regret this}{, but|, however|. Still,|:} I {have to|must|will} {decline|refuse|pass|stop here|say no|leave this unanswered}",
    "{This|The|Your} {request|question|content|topic|material|task} {goes against|violates|conflicts with|is against|is not in line with|breaches} {my guidelines|the content policy|the rules I follow|my policies|our usage rules}",
    "{No|There will be no} {answer|reply|response|comment|label|assessment} {can be given|will be given|can be provided|is possible} {here|from me|to this}{, as I was told not to handle such material|, since it is not allowed|}",
    "{Request|Query|Question|Task} {denied|declined|refused|rejected}{, this is not allowed| for safety reasons|: not permitted|}",
    f"{{Please|You should|You may want to|It is better to}} {{consult|contact|ask|talk to|turn to}} {{a professional|an expert|someone qualified|a lawyer}}{{, as|, because|; |, since}} I {{{_NOT}}} {{{_DO}}}",
    f"I {{have been asked|have been told|was told|am required|am bound}} {{not to|to not}} {{{_DO}}}",
    "I {respectfully |must |will |have to |}{decline|refuse|abstain|pass on this|opt out}{ here| to answer|}",
    "{Let us|Let's|Could we} {talk about|move on to|turn to} {something else|another topic}{, I would rather not answer this|; this I cannot answer|, as this is not allowed}",
    "{I'd|I would} {rather|prefer to} {not say|leave that alone|keep out of this|stay away from that|not get into it|skip this one}",
    "{Ich|Leider} {kann|darf|möchte} {ich |}{dazu|darauf|darüber|diese Frage|diese Anfrage|dabei} {leider |}nicht {beantworten|helfen|eingehen|sprechen|Auskunft geben|antworten}|Es tut mir leid, {das|dabei|diese Bitte} kann ich nicht {beantworten|erfüllen|tun}|{Ich muss|Ich werde} {die Antwort verweigern|ablehnen|das ablehnen|diese Anfrage ablehnen}|Als {KI|Sprachmodell} {darf|kann} ich {das|dazu nichts|so etwas} nicht {sagen|beantworten}|Meine {Richtlinien|Regeln} {erlauben|gestatten} mir das nicht",
    "{Je suis désolé|Désolé|Désolée|Malheureusement}, {je ne peux pas|je ne suis pas autorisé à|je dois refuser de|il m'est impossible de} {répondre|répondre à cette question|vous aider|traiter cette demande|fournir cela}|Je {refuse de|ne souhaite pas|dois refuser de|ne peux pas} {répondre|donner suite|commenter ce sujet}|{En tant qu'IA, je|Je} ne {peux|puis} pas {aider avec cela|répondre à cela}",
    "{Lo siento|Lo lamento|Perdón|Disculpe}, {pero |}no {puedo|debo|me es posible} {ayudar con eso|responder|responder a esta solicitud|dar esa información}|No {puedo|estoy autorizado a|me está permitido} {responder a esto|comentar este tema|ayudarle con esto}|{Debo|Tengo que} {negarme a responder|rechazar esta petición}|Como modelo de lenguaje, no puedo {hacer eso|contestar}",
    "{Mi dispiace|Spiacente|Purtroppo}, {ma |}non posso {aiutarti|rispondere|rispondere a questa domanda|fornire queste informazioni|farlo}|Non {posso|mi è permesso|sono autorizzato a} {rispondere|commentare|aiutare con questo}|Devo rifiutare {questa richiesta|di rispondere}",
    "{Desculpe|Sinto muito|Lamento|Infelizmente}, {mas |}não posso {ajudar com isso|responder|responder a este pedido|fornecer essas informações}|{Recuso-me a|Não estou autorizado a} responder",
    "{Het spijt me|Helaas|Sorry}, {maar |}{ik kan|kan ik|ik mag} {hier niet bij helpen|deze vraag niet beantwoorden|daar niet op ingaan}|Ik {moet|wil} dit verzoek weigeren",
    "{Przykro mi|Niestety|Przepraszam}, {ale |}nie mogę {w tym pomóc|odpowiedzieć|odpowiedzieć na to pytanie|udzielić tych informacji}|Muszę odmówić {odpowiedzi|tej prośby}|{Tyvärr|Förlåt}, {men |}jag kan inte {hjälpa till med det|svara på det}|{Üzgünüm|Maalesef}, {bu konuda yardımcı olamam|bu soruyu yanıtlayamam}",
    "{Извините|К сожалению|Простите}, {но |}я не могу {помочь с этим|ответить|ответить на этот вопрос|предоставить эти сведения|это обсуждать}|{Я вынужден|Мне приходится} отказаться {отвечать|от ответа}|{Мне|Мне, как модели,} {нельзя|запрещено} {это обсуждать|отвечать на такие вопросы}",
    "{抱歉|对不起|很抱歉|不好意思}，我{无法|不能|不便}{回答这个问题|提供这些信息|帮助您|处理这个请求|讨论此话题}|我{不能|无法|拒绝}{提供这些信息|回答|评论此事|协助这个请求}|作为{人工智能|语言模型}，我{不能|无法}{这样做|回答}",
    "{申し訳ありませんが|申し訳ございませんが|すみませんが|恐れ入りますが}、{お答えできません|その質問には答えられません|お手伝いできません|対応できません}|{この依頼|その話題|ご質問}には{お応えできません|お答えすることができません|回答を控えます|回答を差し控えます}|{죄송하지만|죄송합니다만} {답변할 수 없습니다|도와드릴 수 없습니다|그 요청은 처리할 수 없습니다}",
    "{عذرا|آسف|أعتذر|للأسف}، {لا أستطيع|لا يمكنني|لا يجوز لي} {المساعدة في ذلك|الإجابة|الرد على هذا الطلب|تقديم هذه المعلومات}|{علي|أنا مضطر إلى} {رفض الإجابة|أن أرفض هذا الطلب}",
    "{क्षमा करें|माफ़ कीजिए|खेद है}, मैं {इसमें मदद नहीं कर सकता|इसका उत्तर नहीं दे सकता|यह जानकारी नहीं दे सकता}|मुझे {उत्तर देने से मना करना होगा|इस पर बोलने की अनुमति नहीं है}|{ขออภัย|ขอโทษ} {ฉันไม่สามารถตอบได้|ผมช่วยเรื่องนี้ไม่ได้|ไม่สามารถให้ข้อมูลนี้ได้}|ฉันต้องขอปฏิเสธคำขอนี้",
)
HELD_OUT = (3, 6, 9, 12, 16)
ENDINGS = ("", ".", ".", "!", " {about this|on this matter|here}.", ", {because|since|as} {it may be harmful|it could cause harm|this is sensitive|it concerns security|that is not allowed}.", ". {Please|Kindly} {ask something else|try another question|rephrase it}.", ". {Is there|Let me know if there is} {anything|something} else I can {do|help with}.", ". Thank you for {understanding|your patience}.")

_WHO = "{The|A|This} {service|gateway|server|client|parser|vendor|reviewer|operator|guest account|backup job|assistant of the help desk|model of the router}|{Nobody|The reviewers|Users|Members|Two hosts}"
#: Statements that share words with refusals; negatives.
LOOKALIKES = (
    f"{{{_WHO}}} {{{{is|was|were}} unable to|cannot|could not|refuses to|refused to|declined to|was not able to|must not|was not permitted to|may not}} {{start after the change|answer requests|open the file|respond to the ping|provide a token|rule out a second flaw|process the request|help|discuss the flaw|log in|reproduce it}}{{, so the record describes an outage|, yet the log is clear| before the update|}}",
    "{The|This} {policy|rule|filter|request|connection} {was refused by|does not allow|is not permitted by|conflicts with|was declined by} {the server|the proxy|guests|the gateway|the access list}{ once strict mode is on| at night|}",
    "{I|We} {can see|see|found|count|note|expect} {two|three|several} {causes|problems|flaws|signs} in {the record|this record|the log}{, and both are local|, one of them known|}",
    "{My|Our} {reading|view|summary} {of the record|of this} is that {the key leaked|the host was not reached|the update failed|nothing else happened}",
    "{Users|Staff|Readers|Please} {should not|must not|do not} {answer the mail|respond to this request|open the link|provide their password|share the code}{, as the sender cannot be verified| before it is checked|}",
    "{Please|Operators should} {consult|contact|ask} {the vendor|the administrator|the help desk} {for the fixed build|before the update|and report matching mails}",
    f"{{I|We}} {{found|observed|noted|read}} that {{users|guests|the gateway|the vendor|the model}} {{cannot|could not|will not|refused to|may not|must not}} {{answer the prompt|provide a fix|respond to requests|comment on tickets|load its policy|accept a token}}",
    "{The firewall|The proxy|The help desk|The vendor} {rejected|denied|refused|declined} {the request|the question|every query}, and {I found no second attempt|we saw no answer|my notes end there|nobody asked again}",
    "{Block|Report|Ignore} the {sender|mail|caller} and do not {reply|respond|answer} to {the message|such requests|any question}",
    "{Requests|Queries|Logins} without {a token|a ticket} are {denied|rejected|not permitted} by {policy|the rules}",
    "{It is|It was} not {possible|safe|allowed} to {log in without a token|read the ledger|keep the old key|start the job twice}",
    "{Das Gateway|Der Dienst|Der Benutzer} {verweigert die Verbindung|kann nicht starten|darf keine Dateien laden}|{Le service|Le serveur} {refuse la connexion|ne peut pas démarrer}|El servidor no puede {responder|arrancar}|Сервер не может {ответить|запуститься}|服务无法启动|服务器拒绝连接|サーバーは接続を拒否した|الخادم لا يستطيع البدء|Il server non può rispondere|서버가 연결을 거부했다",
)
_WHO_BY = {
    "de": ("{Der Dienst|Der Angreifer|Das Protokoll|Eine Rechnung|Der Rechner} {speichert|löscht|meldet|kopiert|prüft|verteilt} {alle Schlüssel|die Daten|das Kennwort|den Zugang|alte Einträge} {ohne jede Prüfung|in der Nacht|auf dem Server|nach dem Start|bei hoher Last}",),
    "fr": ("{Le serveur|La passerelle|Un attaquant|Le service} {efface|bloque|copie|signale|modifie} {les journaux|les comptes|la clé|les réglages du poste} {pendant la nuit|sans contrôle|avec le mot de passe|après le correctif}",),
    "es": ("{El servidor|La pasarela|Un atacante|El módulo} {guarda|borra|copia|bloquea|cambia} {las claves|los registros|la lista de cuentas|el mensaje} {sin control|por la noche|después del cambio|con mucha carga}",),
    "it": ("{Il server|La rete|Un aggressore|Il modulo} {salva|cancella|copia|blocca} {le chiavi|i registri|la lista degli utenti|il messaggio} {senza alcun controllo|durante la notte|dopo la modifica|con il vecchio certificato}",),
    "pt": ("{O servidor|A rede|Um atacante|O módulo} {guarda|apaga|copia|bloqueia} {as chaves|os registos|a lista de contas|a mensagem} {sem qualquer controlo|durante a noite|depois da alteração|com o certificado antigo}",),
    "nl": ("{De server|Het netwerk|Een aanvaller|De dienst} {bewaart|wist|kopieert|blokkeert} {de sleutels|alle logboeken|het wachtwoord|de oude lijst} {zonder controle|in de nacht|na de wijziging|met een oud certificaat}",),
    "pl": ("{Serwer|Napastnik|Moduł|Usługa} {zapisuje|usuwa|kopiuje|blokuje} {klucze|dzienniki|hasło|stare konta} {bez żadnej kontroli|w nocy|po zmianie|na starych maszynach}",),
    "sv": ("{Servern|Angriparen|Tjänsten} {sparar|raderar|kopierar} {nycklarna|loggarna|lösenordet} {utan kontroll|under natten|efter ändringen}",),
    "tr": ("{Sunucu|Saldırgan|Hizmet} {anahtarları|günlükleri|parolayı} {denetim olmadan|gece boyunca|değişiklikten sonra} {saklıyor|siliyor|kopyalıyor}",),
    "ru": ("{Сервер|Шлюз|Злоумышленник|Служба} {хранит|удаляет|копирует|блокирует} {все ключи|старые журналы|список учётных записей|пароль} {без проверки|по ночам|после сбоя|на старых машинах}",),
    "zh": ("{服务器|攻击者|邮件服务|伪造的页面}在{夜间|几分钟之内|没有检查的情况下}{保存|删除|复制|加密}了{所有密钥|旧的日志|访问记录|密码}",),
    "ja": ("{サーバー|攻撃者|メールサービス|偽のページ}は{夜間に|数分以内に|確認なしで}{鍵|古いログ|利用者の記録|設定}を{保存した|消去した|複製した|公開した}",),
    "ko": ("{서버가|공격자가|메일 서비스가} {밤에|몇 분 안에|확인 없이} {모든 키를|오래된 로그를|접근 기록을} {저장했다|삭제했다|복사했다}",),
    "ar": ("{الخادم|المهاجم|خدمة البريد} {يحفظ|يحذف|ينسخ} {كل المفاتيح|السجلات القديمة|قائمة الوصول} {دون أي فحص|أثناء الليل|بعد أول فشل}",),
    "hi": ("{सर्वर|हमलावर|मेल सेवा} {बिना जाँच के|रात में|कुछ मिनटों में} {सभी कुंजियाँ|पुराने लॉग|पहुँच सूची} {सहेजता है|हटाता है|भेजता है}",),
    "th": ("{เซิร์ฟเวอร์|ผู้โจมตี|บริการอีเมล}{เก็บ|ลบ|คัดลอก}{กุญแจทั้งหมด|บันทึกเก่า|รายชื่อบัญชี}{โดยไม่ตรวจสอบ|ในเวลากลางคืน}",),
    "el": ("{Ο διακομιστής|Ο εισβολέας} {αποθηκεύει|διαγράφει} {όλα τα κλειδιά|τα παλιά αρχεία} {χωρίς έλεγχο|τη νύχτα}",),
    "he": ("{השרת|התוקף} {שומר|מוחק} את {כל המפתחות|היומנים הישנים} {ללא בדיקה|בלילה}",),
}
_STOP = {"zh": "。", "ja": "。", "hi": "।", "th": ""}


def refusal(rng: random.Random, held_out: bool) -> str:
    family = rng.choice([i for i in range(len(REFUSALS)) if (i in HELD_OUT) == held_out])
    text = expand(rng.choice(_alternatives(REFUSALS[family])), rng) + (expand(rng.choice(ENDINGS), rng) if family < 17 else rng.choice([".", "", "!"]))
    return text.lower() if rng.random() < 0.1 else text


def lookalike(rng: random.Random) -> str:
    return expand(rng.choice(_alternatives(rng.choice(LOOKALIKES))), rng) + "."


def statement(language: str, rng: random.Random) -> str:
    """One or two plain sentences in a language."""
    make = lambda: expand(rng.choice(_WHO_BY[language]), rng) + _STOP.get(language, ".")
    return " ".join(make() for _ in range(rng.choice([1, 1, 2])))


LANGUAGES = tuple(_WHO_BY)


def _alternatives(template: str) -> list[str]:
    """Bars outside of braces part whole sentences."""
    out, depth = [""], 0
    for c in template:
        depth += (c == "{") - (c == "}")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out
