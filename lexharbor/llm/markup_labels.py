"""The labelled blocks the markup classifier is trained on: written by hand, in small documents so that blocks have neighbours.

Each line is KIND MARK text: h heading, p prose, l entry of a list, c code, t table, f formula, n nothing but marks; MARK is 1 where the
line holds a piece of HTML, Markdown, wiki or LaTeX markup and 0 where it is plain. A line without text is blank.
"""

LABELLED = r"""
h0 1.2 Installing the pump
b
p0 The pump starts when the valve is opened. If a < b and c > d the value is kept, and R&D; signs it.
p0 Both files lie in C:\texts\begin_4\item.dat and the # of entries is 7; see D:\section\part for more.
b
l0 - Open the left valve before the right one is closed.
l0 - Wait until the lamp is green.
l0 • Close both valves again and read the meter.
b
c0     Loop nCount = 1 to nLast step 2
c0     If nCount < 10 and nLast > 12
c0     Call openValve(nCount, nLast) // twice
c0     Quit nState {nMode} /* done */
b
f0 nTotal = (nCount + 1) × nLast² / 2
===
h0 OPEN THE VALVE
b
p0 Syntax: Open valve <name> [, nSpeed [, <number>]]
p0 Costs are $ 12.50 per hour and $ 3 per litre; {nCount} is replaced when it runs.
p0 Call oPump.$start_now or oPump.$stop_all, never both; #ERR3 is kept and a_b_c is _one_name_.
p0 Compare nA == nB first, then nList[nRow[2]] = 2 ** 3.
p0 Multiply nA * 3 * nB & keep the rest (rows 1 | 2 | 3).
b
l0 1. Turn the key to the left and wait.
l0 2. Read the value a second time.
l0 12. nRest^2 - nCount
l0 13. nRest ~ nCount
b
t0 Name	Unit	Kind
t0 Pressure	bar	number
t0 Label	none	text
===
h0 3.4 What is shown
p0 #1 nMode, #2 nRate, #9 none: 3 < 5 > 2 <= 9
p0 The test nA < 3 and nB > 4 must hold, otherwise #F is set to 0 -> 1.
c0 Path C:\views\new\run8.dat
c0 Until nRow == nLast or nRow <> 17
c0 Return aList[aRow[2]]
c0 Send oList.$redraw(nRow,kTrue,5)
c0 Assign #S1 := nRow & 'left side' & #L
p0 For larger pumps we suggest that the valve be opened slowly (see page 14).
c0 x = y[0]; y = {'a': 1}
c0 # the next line counts them
c0 for (i = 0; i < n; i++) { a[i] += b[i]; }
f0 a² + b² = c²
f0 2 × (n + 1) / 3 ≤ n
===
h1 <h1 class="top" id="s1">Installing the pump</h1>
b
p1 <p>The pump starts when the valve is <b>opened</b>. It is redrawn.</p>
p1 <P>Wait until the lamp is green.<br> <code>nCount</code> and then read it again.
n1 <ul>
l1 <li>Open the left valve before the right one is closed.</li>
l1 <li>Wait until the lamp is <em>green</em> again.
n1 </ul>
n1 <ol>
l1 <li>First of all turn the key.</li>
n1 </ol>
n1 <pre><code>
c0 Loop nCount = 1 to nLast step 2
c1 If nCount &lt; 10 and nLast &gt; 12
n1 </code></pre>
c1 <pre><code>Loop nCount = 1 to nLast
c1 Assign nTotal := nCount &amp; 'left'</code></pre>
===
h1 <H3>Open the valve</H3>
b
p1 <div class="txt">There are 7 ways &amp; each depends on the pump.&nbsp; It works.</div>
p1 You can read it twice. <a href="next.html">the next page</a>
p1 The value&#8212;and this is new&#8212;is kept. <span class="kw">nCount</span>
p1 Wait for the lamp. <font color=red>nLamp</font> <tt>nMode</tt>
p1 All are closed. <!-- nCount -->
p1 &nbsp;&nbsp; Wait until both valves are open.
p1 &quot;nMode&quot; is the one that is read.
t1 <table border=1><tr><th>Name</th><th>Unit</th></tr>
t1 <tr><td>Pressure</td><td>bar</td></tr></table>
f1 <i>n</i> = (<i>m</i> + 1) &times; <i>n</i><sup>2</sup>
p1 <p
p1 The rest of it was cut </b> here.
p1 <img src="pump.png" alt="pump"> The pump from the left.
===
h1 ## **Installing the pump**
b
p1 The pump starts when the valve is **opened**. It is redrawn.
p1 Read `nCount` again when the lamp is green.
p1 See [the next page](next.md) or ![pump](pump.png "left").
p1 This is ***new***, that is ~~old~~ and __this__ stays.
p1 See [the page](next.md
b
l1 * **note** Open the left valve before the right one.
l1 + `note` Wait until the lamp is green.
l1 - __note__ Read the meter.
l1 1. `note` Turn the key to the left.
b
n1 ```text
c0 Loop nCount = 1 to nLast step 2
c0 If nCount < 10 and nLast > 12
n1 ```
b
n1 ~~~
c0 Return aList[aRow[2]]
n1 ~~~
===
h0 Open the valve
n1 ===============
b
t1 |Name|Unit|
n1 |---|---:|
t1 |Pressure|bar|
t1 | Label | none |
b
f1 $$ n^2 \leq m $$
f1 $n = \frac{m+1}{2}$
f1 `n = (m + 1) * n`
h1 ### Open the valve
h1 # Pumps and valves
p1 The first line. **nCount** ()
l1 * Open the left valve before the right one is closed.
l1 * Wait until the lamp is green and read the meter.
l1 + Close both valves again.
n1 ```
p0 The valve is closed before the meter is read for the last time.
===
h1 == Installing the pump ==
b
p1 The pump starts when the '''valve''' is ''opened''. It is redrawn.
p1 Read [[nCount]] or [[Help:valves|the page on valves]] again.
p1 Wait {{see|lamps}} until the lamp is green. {{term|nLamp}}
p1 It was so.<ref name="n3" /> Then it was not. __NOTOC__ nCount
l1 * Open the left valve before the right one.
l1 ** '''note''' Wait until the lamp is green.
l1 # ''note'' Read the meter twice.
l1 # Turn the key to the left and wait.
b
n1 {| class="grid"
t1 ! Name !! Unit
n1 |-
t1 | Pressure || bar
n1 |-
t1 | Label || none
n1 |}
===
h1 ===Open the valve===
n1 <syntaxhighlight lang="text">
c0 Loop nCount = 1 to nLast step 2
c0 Send oList.$redraw(nRow,kTrue,5)
n1 </syntaxhighlight>
n1 {{{
c0 Return aList[aRow[2]]
n1 }}}
n1 <nowiki>
c0 Quit nState {nMode} /* done */
n1 </nowiki>
f1 <math>n = (m + 1) \times n^2</math>
p1 The file is here. [[File:pump.png|thumb|The pump]]
h1 ==== Left valves ====
p0 For larger pumps we suggest that the valve be opened slowly.
n1 |}
p0 For smaller ones it does not matter when it is opened.
===
h1 \section{Installing the pump}\label{sec:2}
b
p1 The pump starts when the \textbf{valve} is \emph{opened}. It is redrawn.\\
p1 Read \texttt{nCount} again.\footnote{As above.} The lamp is green~\ref{tab:3}.
p1 See \href{next}{the next page} and \cite{pumps}. \verb|nLamp| is on.
p1 It is {\it nCount} that counts, $\mathit{nLamp}$ is on. \\
n1 \begin{itemize}
l1   \item Open the left valve before the right one.
l1   \item \textit{note} Wait until the lamp is green.
n1 \end{itemize}
n1 \begin{enumerate}
l1 \item Turn the key to the left.
n1 \end{enumerate}
n1 \begin{verbatim}
c0 Loop nCount = 1 to nLast step 2
c0 If nCount < 10 and nLast > 12
n1 \end{verbatim}
===
h1 \subsection*{Open the valve}
n1 \begin{tabular}{ll}
t1 Name & Unit \\ \hline
t1 Pressure & bar \\ \hline
n1 \end{tabular}
f1 \begin{equation}n = \sqrt{m}\end{equation}
f1 \[ n = \sum_{i=1}^{m} i \]
f1 \(n \neq m\)
p1 \includegraphics[width=5cm]{pump} The pump from the left.
n1 \begin{lstlisting}
c0 Assign nTotal := nCount * 3 * 4
n1 \end{lstlisting}
h1 \subsubsection{Left valves}
p1 Costs are \$ 3 and 5 \% of it \& more.
p0 For larger pumps we suggest that the valve be opened slowly.
===
h0 READ THE METER
p0 In früheren Versionen konnte die Pumpe nur 3 Werte halten, was oft zu wenig war.
l0 • Bitte beachten Sie, dass der Wert geprüft werden muss.
l0 3) Danach wird er noch einmal gelesen.
p1 Der Wert ist <b>neu</b> und wird geprüft.
p0 nothing (rows 3 | 4), a <name> and <value> or {x}
p0 a >= b, b <= c, a != b, 5 * 4 * 3, a & b, x ~ y, #3, $5, 50 %, ^ and ~/path/to_it
c0 /* close all of them */
c0 // close all of them
c0 	return a[b[1]]
c0 call("x", 'y') && !z || w
p0 -----
p0 Section 4 -- the valves -- has <number> more, see [2] and [3, p. 7].
===
h1 ## Emptying the tank
b
p0 The tank is emptied before it is cleaned, so nLevel already has a value. Nothing else needs to be done.
===
h1 #### Emptying the tank
p0 Where no name is given, nLevel stands for the tank. To find out how much is left, read nLevel and subtract 3.
b
h1 ### Cleaning the tank
p0 Only trained people should be allowed to clean the tank while it is in use. What happens next depends on the order in which the valves were closed.
b
c0     Loop nCount = 1 to nLast step 2
c0     Assign nTotal := nCount * 3 * 4
===
h0 2.1 Emptying the tank
b
h1 # Emptying
b
p0 In earlier versions the tank could only hold 12 litres, which was often too few.
b
h1 ## Emptying it again
b
l0 - Read the meter when the tank is full.
===
c0 # open the file and read all of its lines
c0 with open(name) as f:
c0     rows = f.read().split(";")
c0     # count them
c0     return len(rows) == 3
===
c0 nCount = 0; # none so far
c0 # set by the caller
c0 if (nCount != nLast) { return aList[0]; }
c0 x += f(y[2], z->w);
===
h0 EMPTY THE TANK
b
p0 There are 7 ways to do this, and each of them depends on the tank that is used. Both methods share the meter, therefore it is read only once.
l1 * Read the meter when the tank is full, then close the valve.
l1 * Where no name is given, nLevel stands for the tank.
l1 + Before you clean the tank, check whether nLevel still points to it.
b
p0 Please note that the tank is closed as soon as nLevel is larger than 12.
===
h0 Emptying the tank
n1 =================
b
p0 The second parameter tells the tank which of the valves should be shown.
===
h0 Cleaning
n1 =======
p0 The value of nLevel does not change while the tank is in use.
===
h1 == Emptying ==
b
p0 Use this command to connect the tank with the meter after the valve has been opened.
===
h1 ===Emptying the tank===
p0 Characters outside the current font are shown as small boxes in the list of tanks.
l1 # Nothing is sent to the meter until the tank is full.
l1 # Each time you save, the tank is emptied and 3 older copies are removed.
b
h1 ==== Cleaning ====
p0 It is not necessary to clear the meter because the tank is emptied first anyway.
===
p0 Here is what is stored for each of the tanks in use.
b
t1 |Tank|Litres|
n1 |---|---|
t1 |Left|12|
t1 |Right|14|
b
p0 All other tanks wait until the left one is full.
===
h0 1.3 Weighing
b
p1 We found that the scale loses its zero whenever somebody opens the lid twice, which happens more often than one would think, and that the list of weights is then redrawn from the start; the value of nWeight does not change while this is done, and the user sees no warning. <b>nWeight</b> Sooner or later every plant needs a way to move the scale between rooms.
p1 Thanks for the hint, with nWeight set to 7 everything works as it should, and nothing has to be read a second time as long as the lid stays closed while the scale is in use. \texttt{nWeight} This chapter explains how the scale, the lid and their settings fit together.
b
p0 You can pass nWeight to the scale, but then the lid is locked. The scale is built before the lid is opened, so nWeight already has a value. I tried to bind the scale to the lid, but the compiler complained about nLid.
t0 Scale	YES	All
t0 Lid	NO	left, right
b
f0 nWeight = (nLid + 1) × nWeight² / 2
b
c0     Return aList[aRow[2]]
c0     Path C:\lids\new\run8.dat
c0 Path C:\lids\new\run9.dat
c0 Call weighAll(nLid, nWeight) // 12
===
h0 WEIGH IT AGAIN
b
h0 2.2 Lids
b
l0 1. Note: Each time you save, the lid is closed and 3 older copies are removed.
l0 2. For large scales we suggest that the lid be closed slowly.
b
p0 nWeight stands first. lid (see page 3)
b
l0 • Weiß jemand, warum die Waage nach der letzten Aktualisierung nicht mehr erscheint?
l0 • Danke für den Hinweis, mit nLid gleich 3 funktioniert jetzt alles.
===
h1 <h2>Weighing</h2>
p0 Before you close the lid, check whether nLid still points to the scale.
p1 Our tests with 12 lids took less than a minute.<br/>
t1 <tr><td>Scale</td><td>YES</td><td>All</td></tr>
t1 <tr><td>nLid</td><td>left</td></tr></table>
n1 </table>
n1 <table>
l1 <li>nLid
n1 <br>
n1 <!-- nLid -->
b
h1 <h1 class="top">Lids</h1>
h1 <H2>Scales and lids</H2>
===
h1 \section{Weighing}
p0 The limit of 12 is checked only at the end, never while the lid is open.
p1 Two people reported that the lid behaves differently once nLid exceeds 3. \emph{nLid}
h1 \subsection*{Lids}\label{sec:7}
b
f1 $nLid = \frac{nLid+1}{3}$
f1 \[ nLid = \sum nRow \]
f1 $$ nLid^2 $$
f1 \begin{equation}
f1 nLid = \sqrt{n}
f1 \end{equation}
l1   \item nLid is read first.
p1 Lids and scales are opened.\\
t1 nLid & left \\ \hline
===
h1 ## **Weighing**
p1 **nLid** () Both methods share the lid, therefore the scale is read only once.
t1 |nLid|left|
l1 - **note** nLid is read first.
l1 1. ***note*** The scale is built before the lid is opened.
h1 #### **Lids and scales** 
n1 ```
c0 Quit nLid {nWeight} /* 3 */
n1 ```
f1 `nLid = (nWeight + 1) * nLid`
n1 ---|---
===
h1 === Weighing ===
p1 '''nLid''' Fixed a fault in which the lid was drawn over the scale.
t1 ! nLid !! left
t1 | nLid || right
l1 ** [[nLid]] is read first.
l1 *# ''nLid'' is read last.
f1 <math>nLid^2 \leq n</math>
n1 __NOTOC__
n1 {|
n1 |-
===
h0 Sorting the parts
n1 =================
b
p0 Two people reported that the list behaves differently once nPart exceeds 12. It is not necessary to clear it first.
===
h0 SORT THE PARTS
b
h0 Parts and lists
n1 ===============
p0  Has anyone seen why the list is drawn twice?
b
l0 - Note
l0 - Parts
===
p0 Nothing is sent until the list is full. Each time you save, the list is cleared and 3 older copies are removed.
h0 Parts
n1 =====
p0 Please note that the list keeps the old value.
===
h0 Parts
b
p0 Name
p0 Unit
c0 nPart
c0 }
c0 else
c0 end
l0 7.
h0 GLOSSARY
p0 -----
h0 Index
p0 ---
p0 The list is cleared.
===
h0 What is stored
p0 --------------
b
t1 |Part|Kind|Place|
n1 |---|---:|---|
t1 |Left lid|yes|upper shelf, lower shelf|
t1 |Right lid|no|lower shelf|
b
p0 For long lists we suggest that the parts be sorted by hand.
t1 | Left lid | yes | upper shelf |
p0 For short lists it does not matter.
t1 |_nPart_|Lists and rows|
t1 |nPart|_Lists and rows_|
t1     |Left lid|_yes_|upper shelf|
===
h1 ### Sort the parts
b
f1 `nPart = (nList + 1) * nPart`
b
h1 \subsection{Sort the parts}\label{sec:3}
b
p1 If nList is empty, the list is redrawn and the user sees no warning. The list is made before the part is opened, so nPart already has a value. \\
p1 You can read it. \\ \verb|nPart| and more.
===
h1 === Sort the parts ===
b
h1 ==Lists==
p0 In short: You can pass nPart to the list, but then the lid is locked.
b
h1 === Open the list ===
b
h1 ## Lists of parts
p0 The limit of 3 is checked only at the end, never while the list is open.
h1 # Lists
b
h1 ==== Places of parts ====
t0 Part	Kind	Place
t0 Left lid	yes	upper shelf
===
p1 *Note* that the _whole_ list is redrawn.
p0 The test a * b * c and a_b and _c must hold; see *.txt and read it.
c0 /* the rest * of it */
p0 The rest of 3 * 4 | 5 is kept || dropped.
c0 x = a || b
===
h0 3.8 Lists of parts
h1 ===Open the list===
b
c0     Path C:\lists\new\run222.dat
c0     Loop nPart = 1 to nList step 1
===
h1 ## Open the list
b
c0     If nPart < 83 and nList > 90
c0     Assign #S1 := nPart & 'left side' & #L
b
h1 === Sort it ===
c0 Quit nPart {nList} /* 9 */
b
h1 #### Sort the list again
b
n1 ```
c0 Return aList[aRow[2]]
n1 ```
===
h1 === Sort the parts ===
b
b
c0 Call sortAll(nPart, nList) // 12
===
h0 4.2 Baking bread
b
p0 Flour, water and salt are mixed in a bowl until no dry spots remain, and the dough then rests under a cloth for about an hour before it is folded for the first time, while the oven warms up and the stone inside it soaks up as much heat as it can hold, because a cold stone gives a pale and heavy loaf that nobody likes.
p1 Flour, water and salt are mixed in a bowl until no dry spots remain, and the dough then rests under a cloth for about an hour before it is folded for the first time, while the oven warms up and the stone inside it soaks up as much heat as it can hold, because a cold stone gives a pale and heavy loaf that nobody likes.<br>
p1 The crust darkens quickly near the end. <i>Rye</i> needs longer than wheat, spelt tears easily, and oats hold hardly any gas at all; a baker who weighs everything, writes down the times and tastes the dough learns more in one week than others do in a year of guessing, and wastes less.
p1 Sourdough is alive&nbsp;and wants to be fed. Nobody should be surprised when it grows out of its jar on a warm day, so it is best kept in something twice as large as it seems to need, with a lid that is not screwed on.
p0 Salt goes in last & is weighed, not guessed: 2 % of the flour, i.e. 10 g for 500 g (see [4]).
b
c0     scale.read() # in grams
c0     if weight >= 500 and weight < 520: stop()
b
l0 - Rye <coarse> or rye <fine>, whichever is at hand
l0 - water at 24 degrees
l0 2) salt, 10 g
===
h1 == Baking bread ==
c0 weigh(flour, 500);
c0 while (temp < 230) { wait(1); }
b
h1 === Rye loaf ===
c0     heat := 250 - minutes * 2
b
h1 ====Crumb====
c0 Path D:\ovens\new\log3.txt
c0 Return loaf[crumb[3]]
b
h1 == Rye ==
l0 - one bowl
l0 - one cloth
b
h1 ===Oven and stone===
t0 Name	Grams	Kind
t0 Rye	300	coarse
b
h1 ## Oven and stone
c0     oven.$heat(230,kTrue,4)
b
h1 ### Rye loaf
n1 <!-- loaf -->
n1 <!-- crumb -->
p1 The stone is hot. <!-- say more here -->
===
c0 #!/bin/sh
c0 # weigh all loaves
c0 for f in *.csv; do
c0   # skip empty files
c0   test -s "$f" || continue
c0   awk '{ s += $2 } END { print s }' "$f" | sort -n >> /tmp/all_loaves.txt
c0 done
c0 # end of it
c0 echo "$total grams in $n loaves" > report_1.txt
===
c0 # settings of the oven
c0 [oven]
c0 stone = yes
c0 # degrees
c0 heat = 230
c0 # the fan is off by default
c0 fan = 0
===
c0 def rise(self, *args, **kwargs):
c0     # one hour per fold
c0     total = a * b * c ** 2
c0     return {"hours": total, "folds": args[0]} if total != 0 else None
c0 class Dough(Base): pass
c0 x = lambda y: y[1:-1] or y[::2]
===
c0 int fold(int *dough, char **argv) {
c0   return *dough * 2 || argv[0] == 0;
c0 }
===
c0 == 3
c0 === undefined ? a : b;
c0 if (x
c0 == y) { z(); }
c0 || last == 4)
c0 && first != 2
c0 | sort | uniq -c
c0 * 3 + 4;
c0 + rest * 2;
===
c0 SELECT loaf, count(*) AS n FROM ovens o JOIN loaves l ON o.id = l.oven_id WHERE l.grams >= 500 GROUP BY loaf;
c0 UPDATE ovens SET heat = heat * 2 WHERE name LIKE '%_stone' AND id <> 3;
c0 -- only the rye
c0 DELETE FROM loaves WHERE kind = 'rye' -- all of them
c0 {"loaf": "rye", "grams": [500, 510], "fan": null}
c0 2024-03-01 12:00:01 [oven-3] WARN heat=230 fan=off -> retry #2
c0 C:\ovens> dir *.log /s | find "rye"
c0 $ make loaves && ls -l *.txt
c0 > loaf("rye")
c0 >>> loaf[2]
===
h0 OVENS AND STONES
b
p0 Loaves: 12 (# of ovens: 2). Batch #7 was sold at $ 4 each, batch #8 at $5 (two for $9).
p0 The share of rye is 3/4 or 75 %, i.e. 5 * 15 = 75, and 2 ^ 3 = 8; a < b holds but b > c does not.
p0 Write to baker_one@ovens.example or to \\server\ovens\new, then open C:\ovens\readme.txt.
p0 The key is <oven_name>_<number>; {n} stands for the number, [x] for a choice, $HOME for the folder.
p0 Fields are named oven_first and oven_last, and the macro OVEN_MAX_HEAT.
p0 It's the baker's "own" way, isn't it? They said 'rye' and 'wheat', not ''.
p0 Bread *, cakes ** and rolls are sold out.
p0 Rye || wheat, either | or; a -> b <- c, x => y, yes/no, and/or, 5-6 pm -- late.
===
h1 Baking bread<br>
b
p1 Feed it <em>twice</em> a day.
p1 Feed it <strong class=x>twice</strong> a day & <u>weigh</u> it.
p1 <p align="left">Feed it twice a day.</p>
p1 <span>Rye</span>
p1 Feed it twice a day.</p>
n1 <div>
p1 Feed it twice a day.</div>
p1 Wheat, rye &amp; oats are fed twice.
p1 5 &lt; 6 and 7 &gt; 6 hold.
p1 See <a href="http://ovens.example/rye?x=1&y=2">the rye page</a> for more.
p1 Ovens<sup>2</sup> and stones<sub>3</sub> are listed.
p1 The rye page <a href="rye.html
p1 <a name="rye"></a> It is listed here.
p1 Feed it. <tt>nRye</tt> Then wait, since the dough was cold and the jar had been shut. It doubles within six hours.
===
l1 <li>Rye
l1 <li>Wheat and oats are fed twice a day until they double.</li>
l1 <li><p>Stones are warmed first.</p></li>
l1 <li class="x">Ovens stay shut.
n1 </ol>
n1 </ul></div>
n1 <ul class="x">
n1 <hr>
n1 <hr />
n1 <br />
n1 <tr>
n1 </tr>
n1 </tbody></table>
n1 <table width="90%" border=0>
n1 <p>
n1 </p>
n1 <div class="x">
n1 </body>
n1 </html>
h1 <h2>Rye
h1 <h4 id="s3">Ovens and stones</h4>
h1 <center><h1>Rye</h1></center>
t1 <td>Rye</td><td>300</td>
t1 <th>Name</th>
t1 <tr><td>Rye loaf</td><td>300 g</td><td>dark crust, long rest</td></tr>
c1 <code>loaf[2] := 3</code>
c1 <pre>loaf[2] := 3</pre>
c1 <code class="x">weigh(flour) &amp;&amp; wait()</code>
===
h1 # Bread
b
p1 Rye is **dark**, wheat is *pale*, oats are ***neither***.
p1 Write `weigh` first, then `wait`; see [rye](rye.md "Rye") and [wheat][2].
p1 ![loaf](loaf.png)
p1 The stone is hot. ![loaf](loaf.png) It stays so for an hour, and the oven is then opened.
p1 ~~Oats~~ Wheat it is, since no oats were left on the day that the last of the loaves was baked.
p1 __Rye__ first.
p1 It is _always_ rye, in every oven and for every stone, as long as there is some left in the bin.
p1 **Rye**
p1 `rye`
p1 [rye]: http://ovens.example/rye
p1 For more see [the rye page](http://ovens.example/rye), which has times, weights and a drawing of the oven that was built last.
b
l1 * Rye
l1 * Wheat and oats
l1 * Stones are warmed before the dough goes in.
l1   * the small ones
l1 + Ovens
l1 + Ovens stay shut until the crust is dark.
l1 - **rye** is dark
l1 - `weigh` the flour
l1 2. *wheat* is pale
l1 3. See [rye](rye.md).
l1 - [rye](rye.md)
l1 • **Stones** are warmed first.
b
h1 ###### Ovens
h1 ## Ovens ##
h1 ## Which **stone** is used?
h1 # `weigh`
b
t1 | Name | Grams |
n1 |:-----|------:|
t1 | Rye | 300 |
t1 | `weigh` | 2 |
n1 |:--|:-:|--:|
n1 --- | --- | ---
n1 |---|
b
n1 ```sh
c0 ls *.txt | wc -l
n1 ```
n1 ````
c0 weigh(1)
n1 ````
n1 ```python
c0 # weigh it
c0 x = loaf["rye"]
b
c0 # and again
c0 y = loaf["oats"] ** 2
n1 ```
===
h0 Bread
n1 =====
b
h0 Bread and rolls
n1 ===============
p0 Rye is dark and wheat is pale.
b
h0 Rolls
p0 ------
p0 Rolls are small.
b
h0 A longer heading on bread
n1 =========================
l0 - rye
===
p0 The first part ends here.
b
p0 ----------
b
p0 The second part starts here.
p0 _________
p0 . . . . .
p0 - - -
===
h1 = Bread =
b
p1 '''Rye''' is dark, ''wheat'' is pale, '''''oats''''' are neither.
p1 See [[rye]], [[rye|the dark one]] and [[:Category:Ovens]].
p1 The stone is hot.{{citation needed|date=May}} It stays so.
p1 {{note|Feed it twice}}
p1 Feed it.<ref>By hand.</ref> Then wait.
p1 __TOC__
n1 __NOEDITSECTION__
p1 [http://ovens.example the oven page] is <nowiki>[[not linked]]</nowiki>.
p1 [[Image:loaf.png|thumb|A loaf]]
p1 Rye needs long rests, and whoever has no patience should bake with wheat instead, as has been said in [[Wheat loaf]] already.
p1 Broken [[link to rye
p1 Broken {{note|rye
b
l1 * Rye
l1 ** Rye, coarse
l1 *** '''Rye''', fine
l1 # Weigh the flour.
l1 # Wait for an hour, then fold the dough and shape it.
l1 ## Fold it twice.
l1 #* Or three times.
l1 * [[Rye]]
b
n1 {|
n1 {| border="1"
t1 ! Name
t1 ! Name !! Grams !! Kind
n1 |-
t1 | Rye || 300 || dark
t1 | Oats
n1 |- class="x"
n1 |}
===
h1 \section{Bread}
b
p1 Rye is \textbf{dark}, wheat is \emph{pale}, see~\cite{baker99} or Section~\ref{sec:rye}.
p1 The loaf weighs $w_1 + w_2$ grams and costs \$ 4.
p1 It holds 75\% rye \& 25\% wheat.
p1 Rye is fed twice.\footnote{By hand.}
p1 {\bf Rye} first, {\em wheat} second. \noindent Oats last.
p1 \noindent Rye needs long rests, and whoever has no patience should bake with wheat instead.
p1 \url{http://ovens.example}
p1 \caption{A loaf of rye}
p1 Rye \\ wheat
p1 The crust is dark. \\
p1 It was \ldots{} late, and \LaTeX\ was not to blame for the burnt loaves that stood on the table.
p1 Broken \textbf{rye
n1 \centering
n1 \begin{figure}[h]
n1 \end{figure}
n1 \label{fig:loaf}
n1 \includegraphics{loaf.png}
n1 \newpage
n1 \hline
n1 \maketitle
b
n1 \begin{itemize}
l1 \item Rye
l1     \item Wheat and oats are fed twice a day until they double.
l1   \item Ovens stay shut.
l1   \item Es gibt drei Sorten, und jede davon braucht eine eigene Schüssel.
l1 \item[Rye] is dark
n1 \end{itemize}
b
h1 \subsubsection{Rye loaf}
h1 \chapter{Ovens and stones}
h1 \paragraph{Oats}
b
n1 \begin{tabular}{|l|r|}
t1 Rye & 300 \\
t1 Oats & 20 \\ \hline
t1 Long rest & dark crust & 3 h \\
n1 \end{tabular}
t1 Rye & 300 \\
t1 Wheat & 20 & pale \\ \hline
b
f1 $$ w = \frac{a}{b} $$
f1 \[ w^2 \]
f1 \( a \leq b \)
f1 $a^2 + b^2 = c^2$
f1 \begin{align} a &= b \\ c &= d \end{align}
n1 \begin{align}
f1 a &= b + \frac{c}{d}
n1 \end{align}
f1 <math>\frac{a}{b}</math>
f1 `w = a / b`
f1 <i>w</i> = <i>a</i> &times; <i>b</i>
f0 w = a / b + c²
f0 w² ≤ 4 × (a + b)
===
p0 Das Brot ruht eine Stunde unter einem Tuch, bevor es zum ersten Mal gefaltet wird; danach wird es gewogen.
p1 Das Brot ruht eine Stunde unter einem Tuch, bevor es zum ersten Mal gefaltet wird.<br/>
p1 Das Brot ruht eine Stunde. [[Roggen]] braucht länger als Weizen, und wer keine Zeit hat, nimmt besser Hafer.
p1 Le pain repose une heure sous un linge. \emph{Le seigle} demande plus de temps que le blé, et l'avoine encore plus.
p1 El pan descansa una hora. **El centeno** tarda más que el trigo, y la avena todavía más.
l1 * Das Brot ruht eine Stunde unter einem Tuch.
l1 # Danach wird es gefaltet und gewogen.
l1 <li>Das Brot ruht eine Stunde unter einem Tuch.</li>
h1 == Das Brot ==
h1 ## Roggen und Weizen
h0 ROGGEN UND WEIZEN
h0 2.7 Roggen und Weizen
l0 • Das Brot ruht eine Stunde.
l0 4. Danach wird es gewogen.
t0 Sorte	Gramm
t0 Roggen	300
===
p1 Sooner or later the jar is empty. ![jar](jar.png)
p1 Sooner or later the jar is empty. \includegraphics[width=4cm]{jar}
p1 Sooner or later the jar is empty. [jar](jar.md)
p1 Sooner or later the jar is empty. `jar`
p1 Sooner or later the jar is empty. {{jar}}
p1 Sooner or later the jar is empty. <img src="jar.png" alt="jar">
p1 Sooner or later the jar is empty. <code>jar</code> It is filled again by whoever sees it first, since that is the rule.
p1 Sooner or later the jar is empty. \cite{jar} It is filled again.
p1 Sooner or later the jar is empty. \ref{jar}
p1 Sooner or later the jar is empty. $\alpha$ It is filled again.
p1 Sooner or later the jar is empty. \jar It is filled again by whoever sees it first.
p1 Please fill it. ''jar'' is the one that counts, and the others do not.
p1 You can fill it. &quot;Jar&quot; is the one that counts.
p1 You can fill it by hand. <kbd>F5</kbd> fills it at once; the lid opens, the light goes on, and the scale is set to zero before the first grain falls.
p1 You can fill it. </font>
p1 <b>Note:</b> fill it.
p1 **Note:** fill it, then close the lid.
p1 '''Note:''' fill it, then close the lid.
p1 \textbf{Note:} fill it, then close the lid.
===
l1 * The boat is washed before the hull is painted, since salt keeps the paint from holding.
l1 * Each sail has a bag of its own, and the bags hang in the order in which the sails are set.
l1 * We lost two hours on the first leg because nobody had looked at the tide.
l1 * A new mast costs 900 more than an old one, but it lasts at least 12 years longer.
l1 * Nobody knows why the second anchor was left on the pier when the crew went home.
l1 * Das Boot wird gewaschen, bevor der Rumpf gestrichen wird.
l1 * Read nDepth first.
p0 After that the boat is ready, and the crew may go ashore until the tide turns.
b
l1 + The boat is washed before the hull is painted, since salt keeps the paint from holding.
l1 + Each sail has a bag of its own, and the bags hang in the order in which the sails are set.
l1 + A compass that was near iron for a long time should be checked before it is trusted again.
l1 + Das Boot wird gewaschen.
b
l1 # The boat is washed before the hull is painted, since salt keeps the paint from holding.
l1 # Each sail has a bag of its own, and the bags hang in the order in which the sails are set.
l1 # Step 4: If the wind drops, the anchor is let down and the crew waits for the tide.
l1 # Nobody knows why the second anchor was left on the pier when the crew went home.
l1 # Das zweite Segel bleibt im Sack, bis der Wind nachlässt.
l1 # Which rope is used for the small boat?
b
l1 # One more: nDepth is read again.
b
l1 ** Each sail has a bag of its own, and the bags hang in the order in which the sails are set.
l1 ** Nobody knows why.
l1 *** Salt keeps the paint from holding.
===
p1 The boat is washed before the hull is painted, since salt keeps the paint from holding, and the crew that has nothing to do in the meantime sews what the last storm has torn, counts the ropes and oils the blocks; whoever is left over cooks. There is always more to cook than one thinks, and less to eat. A new mast costs 900 more than an old one, but it lasts at least 12 years longer, and that is what counts in the end for a boat which sails all year round, in any weather, with a crew that changes twice a month. <b>nDepth</b> is read once an hour.
p0 The boat is washed before the hull is painted, since salt keeps the paint from holding, and the crew that has nothing to do in the meantime sews what the last storm has torn, counts the ropes and oils the blocks; whoever is left over cooks. There is always more to cook than one thinks, and less to eat. A new mast costs 900 more than an old one, but it lasts at least 12 years longer, and that is what counts in the end for a boat which sails all year round, in any weather, with a crew that changes twice a month. nDepth is read once an hour (see page 7).
p1 A compass that was near iron for a long time should be checked before it is trusted again, which takes an hour on a calm day and is not possible at all on a rough one, so most crews do it in the harbour, with the help of a light whose bearing they know from the chart, and note the result on a card that hangs next to the wheel until somebody takes it down; the card of the last boat hung there for eleven years. '''nDepth''' Nobody had ever read it. Each sail has a bag of its own, and the bags hang in the order in which the sails are set, from the bow to the stern, except for the storm sail, which lies on top.
p1 We lost two hours on the first leg because nobody had looked at the tide, and another one on the second leg because everybody had.\footnote{Both days were Sundays.} After that the boat was slow but safe, and the crew slept in turns until the coast came into sight and the first of the harbour lights could be told from the stars that stood just above them, low and yellow and far too many.
p1 There are 12 ways to tie this knot, and each of them holds. __TOC__ nDepth Two people reported that the rope slips when it is wet, which it is most of the time, at least on this boat and in this sea, where even the tea is salty by noon.
p1 Es gibt 12 Arten, diesen Knoten zu binden, und jede davon hält. \texttt{nTiefe} Zwei Leute berichten, dass das Seil rutscht, wenn es nass ist, und nass ist es auf diesem Boot fast immer, jedenfalls im Herbst, wenn selbst der Tee schon am Mittag salzig schmeckt.
p1 Before the sail is set, check whether nDepth still holds. nWind<ref name="a" /> Each time it drops, the bag is closed and 3 older ropes are removed.
p1 Thanks for the hint, with nWind set to 7 the boat turns as it should. [[wind]]
p1 Wenn nWind leer ist, wird das Segel nicht gesetzt. ~~nWind~~ Danke für den Hinweis.
p1 If nWind is empty, nothing is set and the crew sees no warning. Note: {\it nWind} is read again at noon, when the light is best.
p1 <p>If nWind is empty, nothing is set and the crew sees no warning. When the tide turns, the sails of the second boat are set without any further command, as long as the anchor is up.</p>
p1 <P>When the tide turns, the sails of the second boat are set without any further command.
b
c1     If nWind &lt; 12 and nDepth &gt; 7
c1     Until nWind == nDepth or nWind &lt;&gt; 7
c1 Assign #S1 := nWind &amp; 'left sail' &amp; #L
c1 while (n &lt; 7 &amp;&amp; m &gt; 2) { n++; }
c1 &nbsp;&nbsp;return n;
c0     Send oBoat.$turn(nWind,kTrue,5)
c0 Quit nWind {nDepth} /* 12 */
b
l1 - **note** Two people reported that the rope slips when it is wet.
l1 - ~~note~~ Each time the wind drops, the bag is closed and 3 older ropes are removed.
l1 - [[note]] Salt keeps the paint from holding.
l0 - Where no rope is named, nRope stands for the longest one.
l0 • Thanks for the hint, with nRope set to 7 the boat turns as it should.
l1 1. \emph{note} Where no rope is named, nRope stands for the longest one.
l0 2. Where no rope is named, nRope stands for the longest one.
===
h1 \section*{Lock the wheel}
b
p1 Only the skipper may turn the wheel while the anchor is up.<br>
n1 <ul>
l1 <li>Only the skipper may turn the wheel.
l1 <li>Nobody knows why it was locked, and nobody has asked since the last skipper left for good.</li>
n1 </ul>
b
h1 ==Lock the wheel==
p0 Only the skipper may turn the wheel while the anchor is up.
b
t1 |Wheel|YES|All|
t1 |Ropes and sails|NO|North, South|
t0 Wheel	YES	All
t0 Ropes and sails	NO	North, South
t1 | Wheel || YES || All
t1 Wheel & YES & All \\ \hline
t1 <tr><td>Wheel</td><td>YES</td><td>All</td></tr>
t1 |Wheel|Ropes and sails|
t1 |_Wheel_|**Ropes**|
b
h0 LOCK THE WHEEL
h0 LOCK THE WHEEL 
h0 7.3 Lock the wheel
h0 7.3 Lock the wheel 
p0 Compare nWind == nDepth first, then nWind[nDepth[4]] = 6 ** 2. 
f0 nWind = (nDepth + 1) × nWind² / 2 
f0 nWind = (nDepth + 1) × nWind² / 2
p0 See R&D; note 4 in _4_list of nWind__nDepth -> 4
l0 28. nWind ~ nDepth
p0 Syntax: Lock wheel <name> [, nWind [, <number>]]
p0 Multiply nWind * 21 * nDepth & keep the rest (rows 1 | 2 | 3).
p0 The test nWind < 7 and nDepth > 2 must hold, otherwise #F is set.
===
h1 ## Lock the wheel
f1 `nWind = (nDepth + 1) * nWind`
b
h1 ## Ropes
f1 `nRope = nDepth * 2 / (nWind - 1)`
b
h1 # Ropes and sails
p1 `nRope = 3;` sets the rope.
b
h1 ### Ropes and sails
f0 nRope = nDepth × 2
b
h1 ## Turn the wheel
p1 `oBoat.turn(nWind)` turns it.
===
p0 For long ropes we suggest that the wheel be turned slowly.
c1 <pre><code>Assign nRope := nWind * 3 * 4
c0 Send oBoat.$turn(nWind,kTrue,5)
c1 Return aRope[nWind[6]]</code></pre>
b
p1 <p>If nWind is empty, nothing is set.
c1 <pre><code>Loop nWind = 1 to nRope step 2
c1 If nWind &lt; 7 and nRope &gt; 3
c1 Quit nRope {nWind} /* 4 */</code>
b
c1 <code style="x">Path C:\ropes\new\run7.dat
c1 Until nWind == nRope &amp;&amp; nRope &lt;&gt; 7</code>
b
c1 <pre class="x">for (n = 0; n &lt; 7; n++) {
c1   turn(n);
c1 }</pre>
b
t1 |_Ropes and sails_|**NO**|**All**|
t1 |**Wheel**|**YES**|_North_|
t1 |`nWind`|**Wheel**|
t1 |**Wheel**|_YES_|**North, South**|
b
h1 7.4 Lock the wheel <a href="wheel.html">wheel</a>
h1 7.4 Lock the wheel `nWind`
h1 LOCK THE WHEEL '''nWind'''
l0 73. nWind^2 - nDepth
l1 73. nWind^2 - nDepth \textbf{nWind}
===
t1 |**Ropes**|**North**|
t1 |_South_|_North_|
b
t1 |**Ropes**|**YES**|**All**|
t1 |**Ropes and sails**|NO|**North, South**|
b
h1 === Split the rope ===
p0 I tried to bind the rope to the wheel, but the skipper complained about nWind.
h1 == Ropes ==
p0 I tried it.
l1 ** Nobody knows why.
h1 === Trim the sail ===
l1 * Nobody knows why the second anchor was left on the pier.
h1 ==== Sails ====
l1 * Salt keeps the paint from holding, whatever the colour.
h1 == Trim it again ==
p0 There are 7 of them.
h1 ## Trim it again
p0 There are 9 of them, and each of them is wet.
===
t1 <table border=1><tr><th>X</th><th>Y</th></tr>
t1 <tr><td>7</td><td>8</td></tr></table>
b
t1 <table class="w"><tr><th>Rope</th></tr>
t1 <tr><td>9 m</td></tr></table>
b
t1 <table><tr><td>X</td><td>Y</td><td>Z</td></tr></table>
t1 <tr class="w"><th>Z</th><th>W</th></tr>
===
h1 ## w
===
h1 # Z
===
l1 * b
===
h1 == w ==
===
h1 ### Q
p0 Yes.
===
h1 ===Trim the sail===
p0  When the tide turns, the boat is turned too, and whoever stands at the wheel sings. Nobody knows why it is so, and 7 of them never asked.
b
h1 === Split the long rope ===
p0  I tried to bind the rope to the wheel, but the skipper complained about nWind. Where no rope is named, nRope stands for the longest one, and so it was cut.
b
h1 ==== Mend the sail ====
p0  Das Segel wird geflickt, sobald der Wind nachlässt.
b
h0 Ropes and sails
n1 ===============
t1 |Rope|Metres|Kind|
n1 |---|---|---|
t1 |Long|90|wet|
b
l1 ** Each time the wind drops, the bag is closed and 3 older ropes are removed.
n1 {{{
c0 Send oBoat.$turn(nWind,kTrue,5)
n1 }}}
b
l1 * Use this rope to bind the boat to the pier after the anchor has been let down.
n1 ```
c0 Path C:\ropes\new\run7.dat
n1 ```
===
p0 plain talk.
p1 <p>seven
===
p1 <p>Yes
p1 <b>no</b>
p1 seven<br>
p1 <P>It is.
t1 | Lists and rows || YES || All
t1 | Wheel || NO || North, South
t1 | Screen || YES || North
===
c0     Send oBoat.$turn(nWind,kTrue,5)
h1 === Split the rope ===
p0 Nobody knows why the second anchor was left on the pier when the crew went home.
b
c0 Path C:\ropes\new\run7.dat
h1 ===Trim the sail===
h0 1.8 Open the bag
b
c0     Quit nWind {nDepth} /* 12 */
h1 ### Turn the wheel
h0 1.3 Lock the wheel
b
c0     Return aList[aRow[2]]
h1 == Ropes and sails ==
p0 There are 7 ways to tie this knot, and each of them holds.
b
f0 nWind = (nDepth + 1) × nWind² / 2
h1 #### Turn the wheel again
p0 Read nDepth first.
b
p0 Compare nWind == nDepth first, then nWind[nDepth[4]] = 6 ** 2.
h1 === Mend the sail ===
p0 Das Segel wird geflickt, sobald der Wind nachlässt.
b
c0 Call turnAll(nDepth, nWind) // 12
h1 ## Ropes
l0 - Note
b
c0     If nWind < 7 and nDepth > 3
l1 * The boat is washed before the hull is painted, since salt keeps the paint from holding.
l1 * Nobody knows why.
b
p0 See R&D; note 4 in _4_list of nWind__nDepth -> 4
l1 # The boat is washed before the hull is painted, since salt keeps the paint from holding.
"""
