"""Small invented pages in the layout of the bulletin site (FIXTURES.md
section 3).  All names are invented."""

LISTING_URL = "https://bulletins.example.org/AccesoLibre/LiAcuerdos.aspx"


def _a(name, jid, cls="a"):
    return (f'<a class="{cls}" href="LiAcuerdosBusqueda.aspx?MpioId=3&amp;JuzId={jid}'
            f'&amp;JuzDescrip=X">{name}</a>')


LISTING = (
    "<html><body><div>"
    + _a("Inicio", 90) + _a("Ayuda", 91) + _a("Mapa", 92)
    + '<table id="tblLaPaz"><tr><td>' + _a("Primero Mercantil", 1) + "</td></tr>"
    + "<tr><td>" + _a("Segundo Familiar", 2) + "</td></tr>"
    + '<tr><td><a class="b" href="LiAcuerdosBusqueda.aspx?JuzId=7">Otro</a></td></tr></table>'
    + '<table id="tblLosCabos"><tr><td>' + _a("Primero Penal", 3) + "</td></tr>"
    + "<tr><td>" + _a("Primero Penal Renombrado", 3) + "</td></tr></table>"
    + "</div></body></html>"
)

POSTBACK = "javascript:__doPostBack('ctl00$ContentPlaceHolder1$Calendar1','{}')"

CALENDAR = (
    '<html><body><form><input type="hidden" id="__VIEWSTATE" value="vs1"/>'
    '<input type="hidden" id="__EVENTVALIDATION" value="ev1"/>'
    '<table id="ctl00_ContentPlaceHolder1_Calendar1">'
    '<tr><td colspan="7"><table><tr><td><a href="' + POSTBACK.format("V8309") + '">&lt;</a></td>'
    "<td>noviembre de 2022</td>"
    '<td><a href="' + POSTBACK.format("V8370") + '">&gt;</a></td></tr></table></td></tr>'
    "<tr><th>lu</th><th>ma</th></tr>"
    '<tr><td><a href="' + POSTBACK.format("8367") + '" title="28 de noviembre">28</a></td>'
    '<td><a href="' + POSTBACK.format("8368") + '" title="29 de noviembre">29</a></td></tr>'
    "</table></form></body></html>"
)

DAY = (
    '<html><body><table id="ctl00_ContentPlaceHolder1_tblResultados"><tbody>'
    '<tr><td valign="top"><b>EXPEDIENTE: 12/2020</b></td><td>1</td>'
    '<td valign="top">ORDINARIO CIVIL.- JUAN P&Eacute;REZ VS ANA &amp; CIA.- SE ADMITE<br>SENTENCIA DEFINITIVA</td>'
    '<td valign="top">S&iacute;ntesis:&nbsp;uno</td></tr>'
    '<tr><td>sin valign</td></tr>'
    '<tr><td valign="top">7/2021</td><td>2</td>'
    '<td valign="top">DIVORCIO.- <table><tr><td>LUIS</td></tr></table> VS MARIA</td>'
    '<td valign="top"></td></tr>'
    "</tbody></table></body></html>"
)

DEEP = (
    '<html><body><table id="ctl00_ContentPlaceHolder1_tblResultados"><tbody>'
    '<tr><td valign="top">1/2020</td><td>1</td>'
    '<td valign="top">A.- <table><tr><td><table><tr><td>HONDO</td></tr></table></td></tr></table> VS B</td>'
    '<td valign="top">s&iacute;</td></tr>'
    '<tr><td valign="top">2/2020</td><td>2</td><td valign="top">C VS D</td><td valign="top"></td></tr>'
    "</tbody></table></body></html>"
)
